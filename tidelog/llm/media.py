"""Media columns: Netpbm and BMP images as columns of bytes.

Codecs for P1 to P6 and for uncompressed BMP of 8 and 24 bits, decoded to numpy
arrays; area resizing by integral images; NPY tiles; difference hashes.

``text_media`` stores any payload of bytes losslessly as an 8-bit image of 64
columns, reads the stored bytes back, and computes features from what it read.

Defined cases: a null text is an empty one, whose payload is 64 bytes of 0;
damaged media raise ValueError; an empty table gives an empty result; equal
texts give equal values.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_or_empty
from .text import buffer_of, give_back

WIDTH = 64
HASH_ROWS, HASH_COLS = 8, 9
_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


def encode_netpbm(a: np.ndarray) -> bytes:
    """P5 of a grey array, P6 of a colour array, both of 8 bits."""
    if a.dtype != np.uint8 or a.ndim not in (2, 3) or a.ndim == 3 and a.shape[2] != 3:
        raise ValueError("an array of 8-bit grey or RGB samples is needed")
    return b"P%d\n%d %d\n255\n" % (5 if a.ndim == 2 else 6, a.shape[1], a.shape[0]) + np.ascontiguousarray(a).tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 with at most 8 bits a sample; bitmaps become 0 (black) and 255."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    at, head = 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("the header ends early")
        head.append(int(m[1]))
        at = m.end()
    w, h = head[:2]
    top = head[2] if len(head) > 2 else 1
    if not 0 < top < 256:
        raise ValueError("samples of more than 8 bits are not supported")
    planes = 3 if kind in (b"P3", b"P6") else 1
    n = w * h * planes
    if kind in (b"P5", b"P6"):
        raw = np.frombuffer(data, np.uint8, offset=at + 1)
        if len(raw) < n:
            raise ValueError("the samples end early")
        out = raw[:n]
    elif kind == b"P4":
        stride = (w + 7) // 8
        raw = np.frombuffer(data, np.uint8, offset=at + 1)
        if len(raw) < stride * h:
            raise ValueError("the samples end early")
        out = 1 - np.unpackbits(raw[: stride * h].reshape(h, stride), axis=1)[:, :w].reshape(-1)
    else:
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        digits = re.findall(rb"[01]", body) if kind == b"P1" else body.split()
        if len(digits) < n:
            raise ValueError("the samples end early")
        out = np.array([int(x) for x in digits[:n]], np.uint8)
        if kind == b"P1":
            out = 1 - out
    if top != 255:
        out = (out.astype(np.uint32) * 255 // top).astype(np.uint8)
    return out.reshape((h, w, 3) if planes == 3 else (h, w))


_GREYS = b"".join(bytes((i, i, i, 0)) for i in range(256))


def encode_bmp(a: np.ndarray) -> bytes:
    """BMP of 8 bits with a palette of greys, or of 24 bits; rows bottom up."""
    if a.dtype != np.uint8 or a.ndim not in (2, 3):
        raise ValueError("an array of 8-bit grey or RGB samples is needed")
    h, w = a.shape[:2]
    bits, palette = (8, _GREYS) if a.ndim == 2 else (24, b"")
    line = w * bits // 8
    rows = np.zeros((h, (line + 3) // 4 * 4), np.uint8)
    rows[:, :line] = (a if a.ndim == 2 else a[:, :, ::-1]).reshape(h, line)
    start = 54 + len(palette)
    body = rows[::-1].tobytes()
    head = b"BM" + struct.pack("<IHHI", (start + len(body)) & 0xFFFFFFFF, 0, 0, start)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, bits, 0, len(body) & 0xFFFFFFFF, 2835, 2835, len(palette) // 4, 0) + palette + body


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 bits (grey where its palette is) or 24 bits."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP image")
    start = struct.unpack_from("<I", data, 10)[0]
    size, w, h, _, bits, how, _, _, _, used, _ = struct.unpack_from("<IiiHHIIiiII", data, 14)
    if how or bits not in (8, 24) or w <= 0:
        raise ValueError("this kind of BMP is not supported")
    stride = (w * bits // 8 + 3) // 4 * 4
    raw = np.frombuffer(data, np.uint8, offset=start)
    if len(raw) < stride * abs(h):
        raise ValueError("the samples end early")
    rows = raw[: stride * abs(h)].reshape(abs(h), stride)[:, : w * bits // 8]
    rows = rows[::-1] if h > 0 else rows
    if bits == 24:
        return np.ascontiguousarray(rows.reshape(abs(h), w, 3)[:, :, ::-1])
    palette = np.frombuffer(data, np.uint8, (used or 256) * 4, 14 + size).reshape(-1, 4)[:, 2::-1]
    if (palette[:, :1] == palette).all():
        grey = np.zeros(256, np.uint8)
        grey[: len(palette)] = palette[:, 0]
        return grey[rows]
    full = np.zeros((256, 3), np.uint8)
    full[: len(palette)] = palette
    return full[rows]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def resize_area(a: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Means over the areas that the target's cells cover, in float64: differences
    of the integral image, which is linear between whole samples."""
    if a.ndim == 3:
        return np.stack([resize_area(a[:, :, i], rows, cols) for i in range(a.shape[2])], axis=2)
    h, w = a.shape
    integral = np.zeros((h + 1, w + 1), np.float64)
    np.cumsum(a, axis=0, dtype=np.float64, out=integral[1:, 1:])
    np.cumsum(integral[1:, 1:], axis=1, out=integral[1:, 1:])

    def between(x: np.ndarray, n: int, cells: int, axis: int) -> np.ndarray:
        at = np.arange(cells + 1) * (n / cells)
        lo = np.minimum(at.astype(int), n)
        part = at - lo
        hi = np.minimum(lo + 1, n)
        shape = [1, 1]
        shape[axis] = -1
        part = part.reshape(shape)
        return x.take(lo, axis) * (1 - part) + x.take(hi, axis) * part

    corner = between(between(integral, h, rows, 0), w, cols, 1)
    return np.diff(np.diff(corner, axis=0), axis=1) / ((h / rows) * (w / cols))


def difference_hash(a: np.ndarray) -> str:
    """64 bits, in hex: whether each cell of an 8 by 9 grid is darker than the next."""
    grid = resize_area(a if a.ndim == 2 else a.mean(axis=2), HASH_ROWS, HASH_COLS)
    return np.packbits((grid[:, :-1] < grid[:, 1:] - 1e-9).reshape(-1)).tobytes().hex()


def npy_tile(a: np.ndarray, rows: int, cols: int) -> bytes:
    """An NPY file of the image resized to 8-bit samples."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(resize_area(a, rows, cols)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def payload_of(text: bytes) -> bytes:
    """The text and bytes 0 up to a positive multiple of the row's width."""
    rows = max(1, -(-len(text) // WIDTH))
    return text + bytes(rows * WIDTH - len(text))


def store(payload: bytes, form: str) -> bytes:
    a = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return encode_bmp(a) if form == "bmp" else encode_netpbm(a)


_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, form string, tile_bytes long, tile_crc32 long"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def media_rows(keep_media: bool, tile: int):
    def run(batches):
        for batch in batches:
            give_back()
            buf, off = buffer_of(batch.column(1))
            ids = batch.column(0).to_pylist()
            out: list[list] = [[] for _ in range(len(_NAMES) + 2 * keep_media)]
            for i, key in enumerate(ids):
                text = buf[off[i] : off[i + 1]].tobytes()
                form = "bmp" if len(text) % 2 else "pgm"
                media = store(payload_of(text), form)
                image = decode(media)
                back = image.tobytes()
                tiles = npy_tile(image, tile, tile)
                row = [key, len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(image), form, len(tiles), zlib.crc32(tiles)]
                for c, v in zip(out, row + ([media, tiles] if keep_media else [])):
                    c.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=_NAMES + (["media", "tile"] if keep_media else []))

    return run


def text_media(df: DataFrame, keep_media: bool = False, tile: int = 16) -> DataFrame:
    """One row a document: digests and features, and with ``keep_media`` the stored
    image and its NPY tile as binary columns.  The form is PGM for texts with an
    even number of bytes and BMP for the others."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(media_rows(keep_media, tile), _SCHEMA + (", media binary, tile binary" if keep_media else ""))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(documents(spark, sf_dir))
