"""Scalar functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def clean_text(value: Column, array: bool = False) -> Column:
    """Null as "", a list joined by spaces."""
    return F.coalesce(F.array_join(value, " ") if array else value.cast("string"), F.lit(""))


def matches(text: Column, pattern: str, unicode: bool = False) -> Column:
    """Case-insensitive search. ``unicode`` makes word borders and classes those of all scripts."""
    return text.rlike(("(?iU)" if unicode else "(?i)") + pattern)


def keyword_hits(haystack: Column, terms: tuple[str, ...]) -> Column:
    """The terms that occur in the space-padded lower-case text, each once, in list order."""
    # One comparison a term, not a lambda, so that the lowered text is made once.
    padded = F.concat(F.lit(" "), F.lower(haystack), F.lit(" "))
    return F.array_compact(F.array(*[F.when(F.contains(padded, F.lit(t)), F.lit(t.strip())) for t in terms]))


def keyword_score(haystack: Column) -> Column:
    """struct(score, positive, negative): twice the positive terms less three times the negative."""
    positive, negative = keyword_hits(haystack, C.POSITIVE_TERMS), keyword_hits(haystack, C.NEGATIVE_TERMS)
    return F.struct((2 * F.size(positive) - 3 * F.size(negative)).alias("score"), positive.alias("positive"), negative.alias("negative"))


def is_low_value(question: Column, unicode: bool = False) -> Column:
    """Empty, or of a low-value pattern without a reasoning term."""
    text = F.trim(F.coalesce(question, F.lit("")))
    any_pattern = reduce(Column.__or__, [matches(text, p, unicode) for p in C.LOW_VALUE])
    return (text == "") | (any_pattern & ~matches(text, C.REASONING, unicode))


def conflicts_with_layout(question: Column, is_multi_panel: Column, panel_count: Column, unicode: bool = False) -> Column:
    """A question about panels of a chart that has one."""
    several = F.coalesce(is_multi_panel, F.lit(False))
    count = F.coalesce(F.nullif(panel_count, F.lit(0)), F.when(several, 2).otherwise(1))
    return matches(F.coalesce(question, F.lit("")), C.PANELS, unicode) & (~several | (count <= 1))


def parse_numbers(text: Column) -> Column:
    """All numbers of a text as doubles: signs, thousands commas, exponents; a percent sign divides by 100."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(C.NUMBER), F.lit(0))

    def value(token: Column) -> Column:
        number = F.regexp_replace(token, r"[,%\s]", "").try_cast("double")
        return F.when(token.endswith("%"), number / 100).otherwise(number)

    return F.array_compact(F.transform(tokens, value))


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, C.ASCII_MARKS + C.CJK_MARKS, "")


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_ascii(value: Column) -> Column:
    """The text part of answer normalisation for texts that compatibility forms leave alone."""
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    text = F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"\b(the|a|an)\b", " ")
    return squeeze(strip_punctuation(text))


_QUOTES = "`\"'“”‘’"


def _unquoted(text: Column) -> Column:
    return F.btrim(text, F.lit(_QUOTES))


def strip_reasoning(text: Column) -> Column:
    return F.regexp_replace(text, r"(?is)<think>.*?</think>", "")


def last_line(text: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\r\n|\r|\n"), -1)


def final_answer(text: Column, compat: bool = False) -> Column:
    """What follows the first "final answer:", its first line without tags and quotes; else the last line.

    A marker that the reasoning block quotes does not count unless ``compat``.
    """
    text = F.coalesce(text, F.lit(""))
    shown = text if compat else F.coalesce(F.nullif(F.regexp_replace(strip_reasoning(text), r"^\s+|\s+$", ""), F.lit("")), text)
    marked = F.regexp_extract(shown, r"(?is)final answer\s*:\s*(.+)", 1)
    answer = F.regexp_replace(F.regexp_replace(marked, r"(?i)</?answer>", ""), r"^\s+|\s+$", "")
    first = F.trim(F.element_at(F.split(answer, r"\r\n|\r|\n"), 1))
    return F.when(marked != "", _unquoted(first)).otherwise(_unquoted(F.trim(last_line(shown))))


def final_answer_to_end(text: Column) -> Column:
    """The older form: everything after the first marker, else the last line."""
    text = F.coalesce(text, F.lit(""))
    marked = F.regexp_extract(text, r"(?is)final answer\s*:\s*(.+)", 1)
    return F.when(marked != "", F.regexp_replace(marked, r"^\s+|\s+$", "")).otherwise(F.trim(last_line(text)))


def short_answer(text: Column) -> Column:
    """What follows the last "final answer:", else the last line that is not Markdown."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), F.trim), lambda x: (x != "") & ~x.startswith("**") & ~x.startswith("#") & ~x.isin("```", "```text", "```json"))
    at = F.length(text) - F.length(F.substring_index(F.lower(text), "final answer:", -1))
    return F.when(F.contains(F.lower(text), F.lit("final answer:")), F.trim(F.substring(text, at + 1, F.length(text)))).when(
        F.size(lines) > 0, F.btrim(F.element_at(lines, -1), F.lit('"'))
    ).otherwise(text)


def stable_id(prefix: str, value: Column) -> Column:
    """prefix_safe-text_digest: content decides the id, so a resumed run never reuses one."""
    safe = F.btrim(F.left(F.regexp_replace(value, "[^A-Za-z0-9_.-]+", "_"), F.lit(80)), F.lit("_"))
    return F.concat_ws("_", F.lit(prefix), F.nullif(safe, F.lit("")), F.left(F.sha1(value.cast("binary")), F.lit(16)))


def candidate_id(paper_id: Column, figure_index: Column, merged: Column, image_index: Column) -> Column:
    index = F.coalesce(F.nullif(image_index, F.lit(0)), F.lit(1))
    return F.when(merged, F.format_string("%s_fig%04d_merged", paper_id, figure_index)).otherwise(F.format_string("%s_fig%04d_img%02d", paper_id, figure_index, index))


def shard_of(key: Column, shards: int) -> Column:
    """The first 12 hex digits of the id's sha1, modulo the number of shards."""
    return F.pmod(F.conv(F.left(F.sha1(key.cast("string").cast("binary")), F.lit(12)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def question_tokens(question: Column) -> Column:
    """Distinct lower-case words of over two letters that are no stop words."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(question, F.lit(""))), r"[^a-z0-9\s]", " "), r"\s+")
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*C.QUESTION_STOP_WORDS))
    return F.array_distinct(kept)


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all elements of two arrays; 0 for two empty ones."""
    union = F.size(F.array_union(left, right))
    return F.when(union > 0, F.size(F.array_intersect(left, right)) / union).otherwise(0.0)


def sha1_file(content: Column) -> Column:
    """The digest of a file's bytes."""
    return F.sha1(content)


def hamming_hex(left: Column, right: Column) -> Column:
    """Bits that differ in two hex numbers of any length; the shorter one is filled up with zeros in front."""
    digits = F.greatest(F.length(left), F.length(right))
    size = (F.ceil(digits / 15) * 15).cast("int")
    number = lambda c, at: F.conv(F.substring(F.lpad(c, size, F.lit("0")), at, F.lit(15)), 16, 10).cast("bigint")
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(size - 14, F.lit(1)), F.lit(15)), lambda at: F.bit_count(number(left, at).bitwiseXOR(number(right, at))))
    return F.aggregate(pieces, F.lit(0), lambda total, n: total + n)


def difficulty_score(difficulty: Column, steps: Column) -> Column:
    base = F.when(F.lower(difficulty) == "hard", 3).when(F.lower(difficulty) == "medium", 2).otherwise(1)
    return base + F.coalesce(F.nullif(steps, F.lit(0)), F.lit(1))


def chart_bucket(chart_types: Column, is_multi_panel: Column) -> Column:
    """One of eight buckets by ordered substring rules over the joined lower-case types."""
    joined = F.lower(F.array_join(F.coalesce(chart_types, F.array()), " "))
    rules = (
        (("line", "curve"), "line_chart"),
        (("bar",), "bar_chart"),
        (("scatter",), "scatter_plot"),
        (("heatmap", "confusion", "matrix"), "heatmap_confusion_matrix"),
        (("histogram", "density", "distribution"), "histogram_density_distribution"),
        (("box", "violin", "area"), "box_violin_area"),
    )
    return F.coalesce(
        *[F.when(reduce(Column.__or__, [F.contains(joined, F.lit(w)) for w in words]), F.lit(name)) for words, name in rules],
        F.when(F.coalesce(is_multi_panel, F.lit(False)), F.lit("multi_panel_chart")),
        F.lit("other"),
    )


def year_month_from_path(path: Column) -> Column:
    """struct(month, year, bucket) of the first directory named arxiv_YYMM."""
    month = F.nullif(F.regexp_extract(path, r"(?:^|/)arxiv_([0-9]{4})(?=/|$)", 1), F.lit(""))
    return F.struct(month.alias("month"), (2000 + F.left(month, F.lit(2)).cast("int")).alias("year"), F.concat(F.lit("arxiv_"), month).alias("bucket"))


def graphics_path(path: Column) -> Column:
    """Slashes forward, no leading ./, no doubled or trailing slash, lower case."""
    forward = F.replace(F.trim(F.coalesce(path, F.lit(""))), F.lit("\\"), F.lit("/"))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(forward, r"^(\./)+", ""), r"/(\./)+|/{2,}", "/"), r"(?<=.)/$", "")
    return F.lower(F.when(plain == "", ".").otherwise(plain))


def graphics_stem(path: Column) -> Column:
    return F.regexp_replace(graphics_path(path), r"\.(pdf|png|jpg|jpeg|eps|ps|webp|bmp|tif|tiff)$", "")


def figure_key(file_name: Column) -> Column:
    """The figure number of fig_N_img_M_… names, else the name without its suffix."""
    number = F.regexp_extract(file_name, r"^fig_(\d+)_img_\d+_", 1)
    return F.when(number != "", number.cast("bigint").cast("string")).otherwise(F.regexp_replace(file_name, r"\.[^.]*$", ""))


def html_escape(text: Column) -> Column:
    marks = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
    return reduce(lambda t, m: F.replace(t, F.lit(m[0]), F.lit(m[1])), marks, F.coalesce(text.cast("string"), F.lit("")))


def safe_int(value: Column, default: int = 0) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(default))


def enum_or_default(value: Column, allowed: tuple[str, ...], default: Column | str) -> Column:
    text = F.trim(F.coalesce(value, F.lit("")))
    return F.when(text.isin(*allowed), text).otherwise(F.lit(default) if isinstance(default, str) else default)


def truthy(value: Column, kind: str) -> Column:
    """A value's truth as scripts take it: null, 0, "" and empty lists are false, "false" is true."""
    if kind == "boolean":
        found = value
    elif kind == "string":
        found = value != ""
    elif kind.startswith("array"):
        found = F.size(value) > 0
    else:
        found = value != 0
    return F.coalesce(found, F.lit(False))


def within(path: Column, roots: list[str]) -> Column:
    """Whether a path without ``..`` lies in one of the folders; a folder's name must match as a whole."""
    plain = F.regexp_replace(F.coalesce(path, F.lit("")), "/(\\./)*/*", "/")
    inside = reduce(Column.__or__, [(plain == r.rstrip("/")) | plain.startswith(r.rstrip("/") + "/") for r in roots], F.lit(False))
    return inside & ~plain.rlike(r"(^|/)\.\.(/|$)")


def prompt(template: str, context: Column | None = None, limit: int = 5000, **fields: Column) -> Column:
    """A template with ``{name}`` places filled from columns; the context is appended, cut to ``limit`` characters."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    filled = [F.lit(p) if k % 2 == 0 else F.coalesce(fields[p].cast("string"), F.lit("")) for k, p in enumerate(parts)]
    tail = [] if context is None else [F.lit("\n\n"), F.left(F.coalesce(context, F.lit("")), F.lit(limit))]
    return F.concat(*filled, *tail)


def is_wanted_paper(paper_id: Column, year: Column) -> Column:
    """Papers of the wanted years by id and by folder; the id is matched at its start only."""
    return F.coalesce(paper_id.rlike(C.PAPER_ID) & year.between(2020, 2025), F.lit(False))
