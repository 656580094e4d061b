import pytest
from pyspark.sql import functions as F

from siftwork.functions import latex as L
from siftwork.operators import documents


def test_comments():
    assert L.strip_comments("a % b\n50\\% c % d\n\\\\% e\n%") == "a \n50\\% c \n\\\\\n"
    assert L.strip_comments("no\\") == "no\\"


def test_balanced_arguments():
    assert L.command_argument(r"x \title [s] {A {b} c} {d}", "title") == "A {b} c"
    assert L.command_argument(r"\title{open", "title") == "" == L.command_argument("none", "title")
    assert L.remove_command("a\\title{b{c}}d\\title e\nf", "title") == "ad"[:1] + "d" + "f"
    assert L.remove_command(r"a\title{b", "title") == "a"


def test_readable_text():
    assert L.to_text(r"\section{One} \textbf{\emph{two}} \cite{x}~\ref{fig:1} 5\% \unknown[o]{three}\footnote{no {x}}") == "One two [cite] fig:1 5% three"
    assert L.to_text(r"a---b \, c") == "a-b c"
    assert L.to_readable("\\foo") == "\\foo" and L.bare("a\\ b % c\n d") == "abd"


def test_tables():
    raw = r"""\begin{table}\caption{T \emph{x}}\begin{tabular}[t]{l|r}\toprule a & b\\ \midrule \multicolumn{2}{c}{wide} \\[2pt] c \& d & {e & f} \\ & \\
    \bottomrule\end{tabular}\end{table}"""
    assert L.table_rows(raw) == [["a", "b"], ["wide", ""], ["c & d", "e & f"]]
    assert L.caption_of(raw) == "T x"
    assert L.table_rows(r"\begin{tabularx}{3cm}{lr} x & y \end{tabularx}") == [["x", "y"]]
    assert L.table_rows("no table") == [] == L.table_rows(r"\begin{tabular}{l} open")


def test_document():
    tex = r"""\title{On \emph{figures}}\author{A. Writer}
\begin{document}\maketitle
\section{Start}
First paragraph.

Second % hidden
one.
\begin{figure}\includegraphics{x}\caption{A \textbf{plot}}\end{figure}
\subsection*{Next}
\vspace{2em}

\begin{table*}\begin{tabular}{l}1\end{tabular}\end{table*}
\begin{figure*}\caption{B}\end{figure*}
\end{document}"""
    blocks = L.document_blocks(tex)
    assert [b["type"] for b in blocks] == ["title", "author", "heading", "paragraph", "paragraph", "figure", "heading", "table", "figure"]
    assert [b["id"] for b in blocks] == [f"b{k}" for k in range(9)]
    assert blocks[0]["text"] == "On figures" and blocks[4]["text"] == "Second one."
    assert [b.get("figure_index") for b in blocks if b["type"] == "figure"] == [1, 2] and blocks[5]["caption"] == "A plot"
    assert blocks[2]["level"] == 1 and blocks[6]["level"] == 2 and blocks[7]["table_rows"] == [["1"]]
    assert L.document_blocks("") == []


@pytest.mark.parametrize(("kind", "args", "cost"), [("title", {}, 150), ("figure", {"images": 3}, 600), ("table", {"rows": 2}, 306), ("table", {"rows": 99}, 880), ("paragraph", {}, 56)])
def test_costs(spark, kind, args, cost):
    assert L.block_cost(kind, 10, **args) == cost
    native = documents.block_cost(F.lit(kind), F.lit("x" * 10), F.lit(args.get("images", 1)), F.lit(args.get("rows", 0)))
    assert spark.range(1).select(native.alias("c")).first().c == cost


def test_pages_match_a_running_total(spark):
    import random

    rng = random.Random(1)
    rows = [(p, k, rng.choice([56, 300, 900, 2300])) for p in ("a", "b", None) for k in range(40)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = {(r.paper, r.place): r.page for r in documents.paginate(spark.createDataFrame(shuffled, "paper string, place int, cost int"), "paper", "place", "cost").collect()}
    for p in ("a", "b", None):
        page, used = 1, 0
        for k, cost in ((k, c) for q, k, c in rows if q == p):
            if used and used + cost > 2200:
                page, used = page + 1, 0
            used += cost
            assert got[p, k] == page


def test_blocks_figures_and_references(spark):
    papers = spark.createDataFrame([("p", "\\begin{document}See the plot in Figure one.\n\nOther words.\n\\begin{figure}\\caption{c}\\end{figure}\\end{document}")], "paper_id string, tex string")
    blocks = documents.blocks(papers, "paper_id", "tex")
    figures = spark.createDataFrame([("p", 1, "b.json", "b.png", "cap"), ("p", 1, "a.json", "a.png", "first"), ("q", 1, "z", "z", "z")], "paper_id string, figure_index int, json_name string, image_name string, caption_text string")
    rows = {r.type: r for r in documents.with_figures(blocks, figures, "paper_id").collect()}
    assert rows["figure"].images == ["a.png", "b.png"] and rows["figure"].caption == "first" and rows["paragraph"].images == []
    refs = spark.createDataFrame([("p", "f1", "See the\nplot in Figure  one."), ("p", "f2", "in Figure"), ("p", "f3", "absent"), ("q", "f4", "in Figure"), ("p", "f5", " ")], "paper_id string, figure_id string, paragraph string")
    found = {(r.figure_id, r.block_id) for r in documents.references(blocks, refs, "paper_id").collect()}
    assert found == {("f1", "b0"), ("f2", "b0")}
    stats = documents.stats(papers, blocks, "paper_id", "tex").first()
    assert stats.num_blocks == 3 and stats.total_tex_chars == len(papers.first().tex)
