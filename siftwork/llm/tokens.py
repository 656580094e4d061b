"""Whole-text token ids from tokenizer files, with a bounded chunk cache.

A tokenizer first cuts a text into pre-tokens and never merges across their borders. Where the
file's own rules put a border at every white space, a text's ids are the concatenation of its
chunks' ids, and a chunk met before need not be encoded again. Texts for which a chunk border
might fall inside a pre-token, and tokenizers with other rules, are encoded whole.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

CACHE_CHUNKS = 650_000
#: Longer chunks, and whole texts, are not kept.
CACHE_LENGTH = 64
#: Characters of text that are taken apart at once; bounds the memory of the chunk lists.
STEP_CHARS = 1_000_000

_ENCODERS: dict[str, ChunkEncoder] = {}


#: White space to str.split, but not to the tokenizers.
_UNIT_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: White space that meets white space, and the mark below.
_MEETING = ("  ", "\n\n", " \n", "\n ", "\x01")


def _word_chunks(text: str) -> list[str] | None:
    return None if any(c in text for c in _UNIT_SEPARATORS) else text.split()


def _space_chunks(text: str) -> list[str] | None:
    """Cut before every space and line feed; none where one meets another.

    A chunk lacks the space that it starts with; the first, which has none, is marked instead.
    """
    if any(c in text for c in _MEETING):
        return None
    return ("\x01" + text).replace("\n", " \n").split(" ")


def _source(chunk: str) -> str:
    """The text that a chunk of ``_space_chunks`` stands for."""
    if chunk[:1] == "\n":
        return chunk
    return chunk[1:] if chunk[:1] == "\x01" else " " + chunk


def _rules(path: str) -> str:
    """"word", "space" or "": how the file's tokenizer treats white space."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    if rules["model"].get("type") != "BPE":
        return ""
    steps = rules.get("pre_tokenizer") or {}
    parts = steps.get("pretokenizers", [steps])
    first, normalizer = parts[0], rules.get("normalizer") or {}
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "[^\\s\\p{L}\\p{N}]+" in first["pattern"].get("Regex", ""):
        known = [x.get("type") for x in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        return "word" if known and [x.get("type") for x in parts] == ["Split", "ByteLevel"] else ""
    if len(parts) == 1 and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space") and not normalizer:
        return "space"
    return ""


def _byte_symbols() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return dict(zip((b for b in range(256) if b not in plain), range(0x100, 0x200), strict=False))


_SYMBOLS = _byte_symbols()


class ChunkEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), _rules(path)
        self.model = self.tokenizer.model
        self.chunks = {"word": _word_chunks, "space": _space_chunks}.get(self.kind, lambda text: None)
        self.marks = dict(zip(".,;:!?%", self._plain([*".,;:!?%"]), strict=True)) if self.kind else {}
        self.line = self._plain(["\n"])[0] if self.kind == "space" else b""
        self.lead = chr(_SYMBOLS[0x20]) if self.kind == "space" else ""
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.cache: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        """One encoder a worker process and file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _missing(self, chunks: list[str]) -> dict[str, bytes | None]:
        """Ids of chunks: the file's model alone where the steps before it are known, else all of it.

        A chunk that begins or ends with other white space has none: its border may be no pre-token's.
        """
        found, rest, lower, tokenize = {}, {}, self.kind == "word", self.model.tokenize
        for chunk in chunks:
            # Most are letters, or letters and one mark: two pre-tokens, for the model alone.
            lead, head, letters, mark = self.lead, b"", chunk, b""
            if not chunk.isalpha():
                if chunk[:1] == "\n":
                    lead, head, letters = "", self.line, chunk[1:]
                if not letters.isalpha():
                    letters, mark = letters[:-1], self.marks.get(letters[-1:])
            if mark is not None and letters.isalpha() and max(letters) <= "\u00ff":
                if lower:
                    letters = letters.lower()
                if not letters.isascii():
                    letters = letters.encode().decode("latin-1").translate(_SYMBOLS)
                found[chunk] = head + array("I", [t.id for t in tokenize(lead + letters)]).tobytes() + mark
                continue
            text = chunk if lower else _source(chunk)
            if not lower and len(text) > 1 and (text[-1].isspace() or text[1].isspace()):
                found[chunk] = None
            else:
                rest[chunk] = text
        return found | dict(zip(rest, self._plain(list(rest.values())), strict=True))

    def _few(self, texts: list[str]) -> list[bytes]:
        get, rows, new = self.cache.get, [], {}
        for text in texts:
            chunks = self.chunks(text)
            known, holes = [] if chunks is None else list(map(get, chunks)), []
            try:
                at = -1
                while True:
                    at = known.index(None, at + 1)
                    holes.append(at)
                    new[chunks[at]] = b""
            except ValueError:
                pass
            rows.append((text, known, chunks, holes))
        new = self._missing(list(new))
        out = []
        for text, known, chunks, holes in rows:
            for k in holes:
                known[k] = new[chunks[k]]
            whole = chunks is None or (holes and None in known)
            out.append(self._plain([text])[0] if whole else b"".join(known))
        # Frequent chunks come early, so a full cache keeps what it has.
        fit = ((c, ids) for c, ids in new.items() if ids is not None and len(c) <= CACHE_LENGTH)
        self.cache.update(islice(fit, max(0, CACHE_CHUNKS - len(self.cache))))
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; a null text has none."""
        step, chars = [], 0
        for text in texts:
            step.append(text or "")
            chars += len(step[-1])
            if chars >= STEP_CHARS:
                yield from self._few(step)
                step, chars = [], 0
        if step:
            yield from self._few(step)
