"""Image functions on numpy arrays: header reading, average hash, resizing, panel compositing.

No imaging library is needed: Spark's image source decodes, and resampling is a pair of matrix products.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def header(data: bytes) -> tuple[int, int, str] | None:
    """(width, height, format) from a file's first bytes; None for an unknown or broken header."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return (*struct.unpack(">II", data[16:24]), "PNG")
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return (*struct.unpack("<HH", data[6:10]), "GIF")
        if data[:2] == b"BM":
            width, height = struct.unpack("<ii", data[18:26])
            return width, abs(height), "BMP"
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
        if data[:4] in (b"II*\x00", b"MM\x00*"):
            return _tiff(data)
    except (struct.error, IndexError):
        return None
    return None


def _webp(data: bytes) -> tuple[int, int, str] | None:
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"), "WEBP"
    if kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "WEBP"
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", data[26:30])
        return width & 0x3FFF, height & 0x3FFF, "WEBP"
    return None


def _jpeg(data: bytes) -> tuple[int, int, str] | None:
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height, "JPEG"
        at += 2 if marker == 0xFF or 0xD0 <= marker <= 0xD9 else 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def _tiff(data: bytes) -> tuple[int, int, str] | None:
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack(order + "I", data[4:8])
    (count,) = struct.unpack(order + "H", data[at : at + 2])
    found = {}
    for k in range(count):
        tag, kind = struct.unpack(order + "HH", data[at + 2 + 12 * k : at + 6 + 12 * k])
        if tag in (256, 257):
            value = data[at + 10 + 12 * k : at + 14 + 12 * k]
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), value[: 2 if kind == 3 else 4])[0]
    return (found[256], found[257], "TIFF") if len(found) == 2 else None


def _lanczos(size: int, out: int) -> np.ndarray:
    """Weights (out x size) of Lanczos resampling with three lobes, widened when shrinking."""
    scale = max(1.0, size / out)
    centre = (np.arange(out) + 0.5) * size / out
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / scale
    weights = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Lanczos to width x height, rounded between the two passes as 8-bit images are."""
    across = np.clip(np.rint(np.tensordot(pixels.astype(np.float64), _lanczos(pixels.shape[1], width), axes=([1], [1])).swapaxes(1, -1) if pixels.ndim == 3 else pixels @ _lanczos(pixels.shape[1], width).T), 0, 255)
    down = np.tensordot(_lanczos(pixels.shape[0], height), across, axes=([1], [0]))
    return np.clip(np.rint(down), 0, 255).astype(np.uint8)


def grey(pixels: np.ndarray) -> np.ndarray:
    """Luma of an RGB array in 16-bit fixed point; a grey array as it is."""
    if pixels.ndim == 2:
        return pixels
    r, g, b = (pixels[..., k].astype(np.uint32) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def average_hash(pixels: np.ndarray, size: int = 8) -> str:
    """Bits of the shrunken grey image at or above its mean, row by row, as hex digits."""
    small = resize(grey(pixels), size, size)
    bits = (small >= small.mean()).reshape(-1)
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{size * size // 4}x}"


def bounded_size(width: int, height: int, max_pixels: int) -> tuple[int, int]:
    """The size after shrinking to an area; 0 keeps it."""
    scale = math.sqrt(max_pixels / max(width * height, 1)) if max_pixels > 0 else 1.0
    return (width, height) if scale >= 1 else (max(1, int(width * scale)), max(1, int(height * scale)))


def cache_name(path: str, size: int, modified_ns: int, max_pixels: int) -> str:
    """The file name under which a resized copy is kept."""
    import hashlib
    import posixpath
    import re

    digest = hashlib.sha1(f"{path}:{size}:{modified_ns}:{max_pixels}".encode()).hexdigest()[:16]
    stem = re.sub(r"[^A-Za-z0-9_.-]+", "_", posixpath.splitext(posixpath.basename(path))[0])[:80]
    return f"{stem}_{digest}_{max_pixels}.png"


def upright(pixels: np.ndarray, orientation: int) -> np.ndarray:
    """Pixels as they are to be seen, by the EXIF orientation (1 to 8; any other: as they are)."""
    if orientation in (5, 6, 7, 8):
        pixels = pixels.swapaxes(0, 1)
    if orientation in (2, 3, 6, 7):
        pixels = pixels[:, ::-1]
    if orientation in (3, 4, 7, 8):
        pixels = pixels[::-1]
    return np.ascontiguousarray(pixels)


def orientation(data: bytes) -> int:
    """The EXIF orientation of a JPEG file; 1 where it has none."""
    at = 2
    while data[:2] == b"\xff\xd8" and at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] != 0xDA:
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        part = data[at + 4 : at + 2 + size]
        if data[at + 1] == 0xE1 and part[:6] == b"Exif\0\0":
            return _oriented(part[6:])
        at += 2 + size
    return 1


def _oriented(tiff: bytes) -> int:
    order = "little" if tiff[:2] == b"II" else "big"
    number = lambda at, size: int.from_bytes(tiff[at : at + size], order)
    first = number(4, 4)
    entries = (first + 2 + 12 * k for k in range(number(first, 2)))
    found = next((number(at + 8, 2) for at in entries if number(at, 2) == 0x0112), 1)
    return found if 1 <= found <= 8 else 1


def encode_png(pixels: np.ndarray) -> bytes:
    """An RGB or grey array as a PNG file; the same pixels give the same bytes."""
    height, width = pixels.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of a PNG file of 8 bits a channel, not interlaced: what ``encode_png`` writes."""
    width, height, bits, kind, _, _, interlaced = struct.unpack(">IIBBBBB", data[16:29])
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(kind, 0)
    if bits != 8 or interlaced or not channels:
        raise ValueError("this PNG file is of another kind")
    at, packed = 8, b""
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        packed += data[at + 8 : at + 8 + size] if data[at + 4 : at + 8] == b"IDAT" else b""
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * channels)
    if lines[:, 0].any():
        raise ValueError("this PNG file has filtered lines")
    pixels = lines[:, 1:].reshape(height, width, channels)
    return pixels[..., 0] if channels == 1 else pixels


def resized_copy(pixels: np.ndarray, max_pixels: int) -> np.ndarray:
    """RGB pixels shrunk to an area (0: as they are)."""
    width, height = bounded_size(pixels.shape[1], pixels.shape[0], max_pixels)
    rgb = flatten(pixels)
    return rgb if (width, height) == (pixels.shape[1], pixels.shape[0]) else resize(rgb, width, height)


def flatten(pixels: np.ndarray) -> np.ndarray:
    """RGB on white: grey is repeated, transparency blended."""
    if pixels.ndim == 2:
        return np.repeat(pixels[..., None], 3, axis=2)
    if pixels.shape[2] in (2, 4):
        colour = flatten(pixels[..., 0]) if pixels.shape[2] == 2 else pixels[..., :3]
        alpha = pixels[..., -1:].astype(np.float64) / 255
        return np.rint(colour * alpha + 255 * (1 - alpha)).astype(np.uint8)
    return pixels


def merge_row(panels: list[np.ndarray], gap: int) -> np.ndarray:
    """Panels side by side, centred in height."""
    return _line([p.swapaxes(0, 1) for p in panels], gap).swapaxes(0, 1)


def _line(panels: list[np.ndarray], gap: int) -> np.ndarray:
    """Panels one below the other, centred in width, on white."""
    if len(panels) == 1:
        return panels[0]
    width = max(p.shape[1] for p in panels)
    canvas = np.full((sum(p.shape[0] for p in panels) + gap * (len(panels) - 1), width, 3), 255, np.uint8)
    at = 0
    for p in panels:
        left = (width - p.shape[1]) // 2
        canvas[at : at + p.shape[0], left : left + p.shape[1]] = p
        at += p.shape[0] + gap
    return canvas


def merge_grid(rows: list[list[np.ndarray]], gap: int, padding: int) -> np.ndarray:
    """Rows of panels as one picture with a white border."""
    grid = _line([merge_row([flatten(p) for p in row], gap) for row in rows], gap)
    return np.pad(grid, ((padding, padding), (padding, padding), (0, 0)), constant_values=255) if padding else grid


def from_spark(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """The pixel array of a row of Spark's image source (blue first), as RGB."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[..., 0]
    return pixels[..., [2, 1, 0, *range(3, channels)]]


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("format", T.StringType())]))
def image_header(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(header(c) if c else None) or (None, None, None) for c in content], columns=["width", "height", "format"]).astype({"width": "Int32", "height": "Int32"})


@F.pandas_udf(T.StringType())
def image_hash(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
    def one(h: int, w: int, n: int, d: bytes) -> str | None:
        return None if d is None or h < 1 or w < 1 else average_hash(flatten(from_spark(h, w, n, d)))

    return pd.Series([one(*row) for row in zip(height, width, channels, data, strict=True)], dtype=object)


def data_url(content: Column, path: Column) -> Column:
    """An inline image part: its type by suffix, then base64."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    mime = F.when(suffix.isin("jpg", "jpeg"), "image/jpeg").when(suffix.isin("tif", "tiff"), "image/tiff").when(suffix.isin("webp", "bmp", "gif"), F.concat(F.lit("image/"), suffix)).otherwise("image/png")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content))
