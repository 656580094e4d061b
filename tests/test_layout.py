import numpy as np
import pytest

from siftwork.functions import images as I
from siftwork.operators import layout


def panel(k, name=None, original=None):
    return {"image_index": k, "image_name": name or f"fig_0001_img_{k:02d}_p{k}.png", "output_path": None, "original_path": original}


def rows_of(tex, n):
    rows, info = layout.infer_rows([panel(k) for k in range(1, n + 1)], tex)
    return [[p["image_index"] for p in r] for r in rows], info


def inc(k, width=None):
    return rf"\includegraphics{f'[width={width}]' if width else ''}{{./p{k}.pdf}}"


@pytest.mark.parametrize(
    ("tex", "rows"),
    [
        (inc(1) + inc(2), [[1, 2]]),
        (inc(1) + r"\\ " + inc(2), [[1], [2]]),
        (inc(1) + "\n\n" + inc(2), [[1], [2]]),
        (inc(1) + "\\label{a}\n\n" + inc(2), [[1, 2]]),
        (inc(1) + r"\vspace{1em}" + inc(2) + inc(3), [[1], [2, 3]]),
        (inc(1, r"0.5\textwidth") + inc(2, r".5\textwidth") + inc(3, r"0.4\textwidth"), [[1, 2], [3]]),
        (inc(1, r"0.3\linewidth") + inc(2, r"\linewidth") + inc(3), [[1], [2, 3]]),
        (inc(2) + inc(1), [[2, 1]]),
        (inc(1), [[1, 2]]),
        ("", [[1, 2]]),
    ],
)
def test_rows(tex, rows):
    n = max(k for r in rows for k in r)
    assert rows_of(tex, n)[0] == rows


def test_local_widths():
    box = r"\begin{minipage}[t]{0.48\textwidth}" + inc(1, r"\linewidth") + r"\end{minipage}"
    tex = box + box.replace("p1", "p2")
    rows, info = rows_of(tex, 2)
    assert rows == [[1, 2]] and info["includegraphics_widths"] == pytest.approx([0.48, 0.48]) and info["source"] == "figure_tex_includegraphics"


def test_an_unmatched_panel_drops_all_matches():
    rows, info = layout.infer_rows([panel(2), panel(1, "other.png")], inc(2) + r"\\" + inc(3))
    assert [[p["image_index"] for p in r] for r in rows] == [[1, 2]] and info["row_count"] == 1


def test_merged_names():
    assert layout.merged_stem(3, "x", "k") == "fig_0003_merged"
    assert layout.merged_stem(None, "fig_07_img_1_a", "k") == "fig_07_merged" and layout.merged_stem(0, "x", "k") == "k_merged"


def test_figures_and_composites(spark):
    rows = [("d", "1", 1, k, f"p{k}.png", f"fig_1_img_{k}_p{k}.json", f"p{k}.pdf", None, inc(1) + inc(2) + r"\\" + inc(3)) for k in (2, 1, 3)] + [("d", "2", 2, 1, "s.png", "s.json", None, None, None)]
    panels = spark.createDataFrame(rows, "directory string, figure_key string, figure_index int, image_index int, image_name string, json_name string, original_path string, output_path string, figure_tex string")
    merged = layout.merge_figures(panels)
    record = merged.first()
    assert merged.count() == 1 and record.merged_rows == [["p1.png", "p2.png"], ["p3.png"]] and record.merge_layout.row_lengths == [2, 1]
    assert layout.merge_figures(panels, merged).count() == 0
    pixels = lambda w, h, v: bytearray(bytes([v, 0, 0]) * (w * h))
    images = spark.createDataFrame([("d", f"p{k}.png", h, w, 3, pixels(w, h, 50 * k)) for k, (w, h) in {1: (4, 2), 2: (3, 4), 3: (5, 1)}.items()], "directory string, image_name string, height int, width int, channels int, data binary")
    picture = layout.compose(images, merged, gap=1, padding=2).first()
    assert (picture.width, picture.height) == (8 + 4, 4 + 1 + 1 + 4)
    grid = np.frombuffer(picture.data, np.uint8).reshape(picture.height, picture.width, 3)
    assert grid[0, 0].tolist() == [255] * 3 and grid[3, 2].tolist() == [0, 0, 50] and grid[2, 2].tolist() == [255] * 3


def png(width, height):
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + bytes((x * 255 // max(1, width - 1), 0, 7)[k] & 255 for x in range(width) for k in range(3)) for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_headers():
    assert I.header(png(7, 3)) == (7, 3, "PNG")
    assert I.header(b"GIF89a\x05\x00\x04\x00") == (5, 4, "GIF")
    assert I.header(b"BM" + b"\0" * 16 + (9).to_bytes(4, "little") + (-8).to_bytes(4, "little", signed=True)) == (9, 8, "BMP")
    assert I.header(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x10\x00\x20" + b"\0" * 10) == (32, 16, "JPEG")
    assert I.header(b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0\0\0\0\0\x63\0\0\x31\0\0") == (100, 50, "WEBP")
    assert I.header(b"") is None and I.header(b"\x89PNG\r\n\x1a\n") is None and I.header(b"text") is None


def test_hash_through_the_image_source(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(40, 30))
    row = spark.read.format("image").load(f"file://{tmp_path}/a.png").select("image.*")
    got = row.select(I.image_hash("height", "width", "nChannels", "data").alias("h")).first().h
    assert got == "0f0f0f0f0f0f0f0f"  # dark left, bright right
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}")
    header = files.select(I.image_header("content").alias("h"), I.data_url(files.content, files.path).alias("u")).first()
    assert (header.h.width, header.h.format) == (40, "PNG") and header.u.startswith("data:image/png;base64,iVBOR")


def test_resize_and_bounds():
    flat = np.full((30, 20), 77, np.uint8)
    assert (I.resize(flat, 5, 4) == 77).all() and I.resize(np.full((9, 9, 3), 12, np.uint8), 3, 2).shape == (2, 3, 3)
    assert I.bounded_size(100, 100, 2500) == (50, 50) and I.bounded_size(3, 3, 0) == (3, 3)
    assert I.flatten(np.array([[[0, 0, 0, 0]]], np.uint8)).tolist() == [[[255, 255, 255]]]
    assert I.cache_name("/a/b c.png", 1, 2, 3).startswith("b_c_")


def test_files_and_orientation():
    rng = np.random.default_rng(1)
    for shape in ((5, 7, 3), (4, 9), (1, 1, 3)):
        pixels = rng.integers(0, 256, shape, dtype=np.uint8)
        data = I.encode_png(pixels)
        assert (I.decode_png(data) == pixels).all() and I.header(data)[:2] == (shape[1], shape[0])
    with pytest.raises(ValueError):
        I.decode_png(png(3, 3)[:24] + b"\x10" + png(3, 3)[25:])
    grid = np.array([[1, 2, 3], [4, 5, 6]], np.uint8)
    seen = {1: [[1, 2, 3], [4, 5, 6]], 2: [[3, 2, 1], [6, 5, 4]], 3: [[6, 5, 4], [3, 2, 1]], 4: [[4, 5, 6], [1, 2, 3]], 5: [[1, 4], [2, 5], [3, 6]], 6: [[4, 1], [5, 2], [6, 3]], 7: [[6, 3], [5, 2], [4, 1]], 8: [[3, 6], [2, 5], [1, 4]]}
    assert all(I.upright(grid, k).tolist() == v for k, v in seen.items())
    exif = b"Exif\0\0MM\0*\0\0\0\x08\0\x01\x01\x12\0\x03\0\0\0\x01\0\x06\0\0"
    jpeg = b"\xff\xd8\xff\xe1" + (len(exif) + 2).to_bytes(2, "big") + exif + b"\xff\xda"
    assert I.orientation(jpeg) == 6 and I.orientation(b"\xff\xd8\xff\xda") == 1 == I.orientation(b"")
    assert I.resized_copy(np.zeros((20, 20), np.uint8), 100).shape == (10, 10, 3)
