"""Deep-shallow string sorting: multikey quicksort, then blind tries.

``sort_strings`` orders substrings of one buffer. To a shallow depth it is a multikey quicksort
over 8-byte characters: a segment's characters are quicksorted, and the strings that share one go
on to the next character. Strings that still tie there have a long common prefix; each such group
is ordered by a blind trie, which descends by branching bytes alone and compares one string in full
at the leaf, so a long prefix is read once a string and not once a comparison.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the multikey quicksort looks at.
SHALLOW = 32
#: End of a string in a trie: below every byte.
END = -1


class BlindTrie:
    """A blind (Patricia) trie over byte strings; equal strings share a leaf."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        # A leaf is [string, members]; an inner node is (depth, children by byte).
        self.root = None

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = [string, [member]]
            return
        node, path = self.root, []
        while type(node) is tuple:
            depth, children = node
            byte = string[depth] if depth < len(string) else END
            path.append((node, byte))
            node = children.get(byte)
            if node is None:  # blind: any leaf below tells where the strings part
                node = next(iter(children.values()))
                while type(node) is tuple:
                    node = next(iter(node[1].values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        length = min(len(string), len(other))
        differing = int.from_bytes(string[:length], "big") ^ int.from_bytes(other[:length], "big")
        at = length - (differing.bit_length() + 7) // 8
        mine = string[at] if at < len(string) else END
        theirs = other[at] if at < len(other) else END
        leaf = [string, [member]]
        for k, (inner, _) in enumerate(path):
            if inner[0] == at:
                inner[1][mine] = leaf
                return
            if inner[0] > at:
                self._split(path, k, at, theirs, mine, leaf, inner)
                return
        below = path[-1][0][1].get(path[-1][1]) if path else self.root
        self._split(path, len(path), at, theirs, mine, leaf, below)

    def _split(self, path: list, k: int, at: int, theirs: int, mine: int, leaf: list, below) -> None:
        """A new inner node in place of ``below``, the k-th node on the path."""
        new = (at, {theirs: below, mine: leaf})
        if k:
            parent, byte = path[k - 1]
            parent[1][byte] = new
        else:
            self.root = new

    def leaves(self):
        """Members of each distinct string, in order of the strings."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack.extend(child for _, child in sorted(node[1].items(), key=lambda x: x[0], reverse=True))
            else:
                yield node[1]


def _characters(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """The 8-byte characters at ``depth``; bytes past a string's end are zero."""
    words = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
    found = words[np.minimum(starts + depth, len(words) - 1)].astype(np.uint64)
    past = np.clip(depth + 8 - lengths, 0, 8)
    if past.any():
        keep = np.where(past == 8, np.uint64(0), ~np.uint64(0) << (8 * np.minimum(past, 7)).astype(np.uint64))
        found &= keep
    return found


def sort_strings(data: bytes, starts: np.ndarray, lengths: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the strings data[start : start + length] and, along it, their class.

    Classes number the distinct strings from 0 in their order.
    """
    n = len(starts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.frombuffer(data + b"\x00" * 8, np.uint8)
    order = np.arange(n)
    head = np.zeros(n, bool)  # where, along the order, a string differs from the one before
    head[0] = True
    tied = np.arange(n)  # places along the order that share all characters so far with a neighbour
    for depth in range(0, shallow, 8):
        segment = np.cumsum(head)[tied]
        letters = _characters(padded, starts[order[tied]], lengths[order[tied]], depth)
        inner = np.lexsort((letters, segment))
        order[tied] = order[tied][inner]
        letters = letters[inner]
        head[tied[1:]] |= (letters[1:] != letters[:-1]) | (segment[1:] != segment[:-1])
        alone = head & np.r_[head[1:], True]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
    if len(tied):
        begins = np.flatnonzero(head[tied])
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(tied)], strict=True):
            place = tied[a]
            members = order[place : place + b - a].tolist()
            trie = BlindTrie()
            for m in members:
                s = int(starts[m])
                trie.insert(data[s : s + int(lengths[m])], m)
            for same in trie.leaves():
                order[place : place + len(same)] = same
                head[place] = True
                place += len(same)
    return order, np.cumsum(head) - 1


def first_of_class(order: np.ndarray, classes: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each string, the member of its class with the smallest rank."""
    by_rank = np.lexsort((rank[order], classes))
    order, classes = order[by_rank], classes[by_rank]
    lead = np.r_[True, classes[1:] != classes[:-1]]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(lead)][classes]
    return first
