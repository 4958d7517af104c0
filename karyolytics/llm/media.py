"""Media columns: images of Netpbm and BMP form as numpy arrays, stored as NPY tiles, with difference hashes.

A column of image bytes is decoded to arrays of samples (height, width, channels); an array is stored without loss as NPY
tiles of bounded height, one binary array a row, and can be read back. A feature is the difference hash of the image,
resized by area to 9 x 8 through integral images: each cell's mean is exact, as sums of whole numbers, for any size.

Decoded are P1 to P6 with comments and one or two bytes a sample, and uncompressed BMP of 1, 4, 8, 24 and 32 bits,
bottom up or top down. A row is a unit of work of its own, so there is no shuffle.

Cases: null bytes and bytes that are no image of these forms give null columns and a reason in ``error``; images without
any sample have no tiles and a hash of zeros; repeated rows are rows each; an empty table gives an empty result; other columns
are kept by ``media_columns``, with an underscore before those that are named as its own.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, trimmed

#: Rows of samples of a tile, and bytes of tiles that a batch holds.
TILE, BATCH = 256, 4 << 20
#: Samples a row of an image that holds a payload, and its channels.
WIDTH, CHANNELS = 64, 3
ROW = WIDTH * CHANNELS
HEADER = re.compile(rb"(?:\s*#[^\n]*\n|\s)*(\d+)")


def netpbm(data: bytes) -> np.ndarray:
    """P1 to P6: (height, width, 1 or 3) samples of 8 or 16 bits; bitmaps have 255 for white."""
    kind = data[1:2]
    at, sizes = 2, []
    for _ in range(2 if kind in b"14" else 3):
        m = HEADER.match(data, at)
        if not m:
            raise ValueError("header of netpbm")
        sizes.append(int(m[1]))
        at = m.end()
    (w, h), most = sizes[:2], sizes[2] if len(sizes) > 2 else 1
    c = 3 if kind in b"36" else 1
    if not 0 < most < 65536:
        raise ValueError("largest sample of netpbm")
    if kind == b"1":  # digits may stand without white space
        body = np.frombuffer(re.sub(rb"#[^\n]*|\s", b"", data[at:]), np.uint8)[: w * h] - 48
        if (body > 1).any():
            raise ValueError("bits of netpbm")
    elif kind in b"23":
        body = np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[: w * h * c], np.int64).astype(np.uint16 if most > 255 else np.uint8)
    elif kind == b"4":
        body = np.unpackbits(np.frombuffer(data, np.uint8, h * -(-w // 8), at + 1).reshape(h, -(-w // 8)), axis=1)[:, :w].ravel()
    else:
        body = np.frombuffer(data, ">u2" if most > 255 else np.uint8, w * h * c, at + 1)
    if len(body) != w * h * c:
        raise ValueError("samples of netpbm")
    out = body.reshape(h, w, c)
    return 255 * (1 - out) if kind in b"14" else out.astype(np.uint16) if most > 255 else out


def bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP: (height, width, 3 or 4) samples, red first, top row first."""
    number = lambda at, n=4, signed=False: int.from_bytes(data[at : at + n], "little", signed=signed)
    start, head, w, h, bits = number(10), number(14), number(18, signed=True), number(22, signed=True), number(28, 2)
    if head < 40 or number(30) or bits not in (1, 4, 8, 24, 32) or w < 0:
        raise ValueError("form of BMP")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)
    if bits < 24:
        colours = np.frombuffer(data, np.uint8, 4 * (number(46) or 1 << bits), 14 + head).reshape(-1, 4)[:, 2::-1]
        parts = np.unpackbits(rows, axis=1).reshape(abs(h), -1, bits) @ (1 << np.arange(bits)[::-1]) if bits < 8 else rows
        out = colours[parts[:, :w]]
    else:
        c = bits // 8
        out = rows[:, : w * c].reshape(abs(h), w, c)[:, :, [2, 1, 0, 3][:c]]
    return out if h < 0 else out[::-1]


def decode(data: bytes | None) -> np.ndarray:
    """The samples of an image; ValueError if it is none."""
    if data and data[:1] == b"P" and data[1:2] in tuple(b"%d" % i for i in range(1, 7)):
        return netpbm(data)
    if data and data[:2] == b"BM":
        return bmp(data)
    raise ValueError("no bytes" if not data else "neither netpbm nor BMP")


def encode(samples: np.ndarray, form: str) -> bytes:
    """Red, green and blue of 8 bits as ``ppm`` or ``bmp``."""
    h, w, _ = samples.shape
    if form == "ppm":
        return b"P6\n%d %d\n255\n" % (w, h) + samples.tobytes()
    stride = (w * 24 + 31) // 32 * 4
    rows = np.zeros((h, stride), np.uint8)
    rows[:, : 3 * w] = samples[::-1, :, ::-1].reshape(h, 3 * w)
    number = lambda x, n=4: x.to_bytes(n, "little")
    size = 54 + rows.size
    return b"BM" + number(size) + number(0) + number(54) + number(40) + number(w) + number(h) + number(1, 2) + number(24, 2) + number(0) + number(rows.size) + number(2835) * 2 + number(0) * 2 + rows.tobytes()


def area_sums(grey: np.ndarray, h: int, w: int) -> np.ndarray:
    """h x w sums over equal areas of a grey image, in h * w parts of a sample: the resized image times one constant.

    The integral image is read at the cells' corners, between samples too.
    """
    integral = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1), np.int64)
    integral[1:, 1:] = grey.cumsum(0, dtype=np.int64).cumsum(1)

    def cut(a: np.ndarray, n: int) -> np.ndarray:
        size = a.shape[0] - 1
        at, rest = np.divmod(np.arange(n + 1) * size, n)
        step = a[np.minimum(at + 1, size)] - a[at]
        return np.diff(a[at] * n + step * rest[:, None], axis=0)

    return cut(cut(integral, h).T, w).T


def resized(samples: np.ndarray, h: int, w: int) -> np.ndarray:
    """Means over areas, rounded down, in the type of the samples."""
    one = samples.shape[0] * samples.shape[1]
    return np.dstack([area_sums(samples[:, :, i], h, w) // one for i in range(samples.shape[2])]).astype(samples.dtype)


def difference_hash(samples: np.ndarray) -> str:
    """64 bits as hex: of 9 x 8 means of grey, whether each is less than its right neighbour."""
    if not samples.size:
        return "0" * 16
    grey = samples[:, :, :3].astype(np.int64) @ np.array([299, 587, 114]) if samples.shape[2] > 1 else samples[:, :, 0]
    cells = area_sums(grey, 8, 9)
    return np.packbits(cells[:, 1:] > cells[:, :-1]).tobytes().hex()


def tiles_of(samples: np.ndarray, height: int = TILE) -> list[bytes]:
    """NPY files of the image's rows, so many a tile."""
    out = []
    for at in range(0, len(samples), height):
        np.save(f := io.BytesIO(), np.ascontiguousarray(samples[at : at + height]), allow_pickle=False)
        out.append(f.getvalue())
    return out


def from_tiles(tiles: list[bytes]) -> np.ndarray:
    parts = [np.load(io.BytesIO(t), allow_pickle=False) for t in tiles]
    return np.concatenate(parts) if parts else np.zeros((0, 0, 3), np.uint8)


def media_columns(df: DataFrame, media: str = "media", tile: int = TILE) -> DataFrame:
    """df without the column of image bytes, with height, width, channels, tiles (array of NPY files), dhash and error."""
    fields = "height int, width int, channels int, tiles array<binary>, dhash string, error string"
    own = [f.split()[0] for f in fields.split(", ")]
    others = [f for f in df.schema if f.name != media]
    keep = [f"_{f.name}" if f.name in own else f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, size = [], 0, 0
            for i in range(batch.num_rows):
                try:
                    a = decode(batch.column(0)[i].as_py())
                    rows.append((*a.shape, tiles_of(a, tile), difference_hash(a), None))
                    size += a.nbytes
                except (ValueError, IndexError, OverflowError) as e:
                    rows.append((None, None, None, None, None, str(e)))
                if size > BATCH or i + 1 == batch.num_rows:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.string(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols] if len(rows) == batch.num_rows else [*(c.slice(at, len(rows)) for c in batch.columns[1:]), *cols], [*keep, *own])
                    at, rows, size = i + 1, [], 0

    kept = ", ".join(f"`{k}` {f.dataType.simpleString()}" for k, f in zip(keep, others))
    return df.select(F.col(f"`{media}`"), *(F.col(f"`{f.name}`").alias(k) for k, f in zip(keep, others))).mapInArrow(trimmed(run), f"{kept}, {fields}" if kept else fields)


def payload_images(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as images that hold their bytes, without loss: id, n_bytes, media.

    The bytes are filled up with spaces to whole rows of 64 pixels; an image of an odd number of rows is a PPM, else a BMP.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, sizes, at, size = [], [], 0, 0
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                data = texts[i].as_py() or b""
                full = data.ljust(max(1, -(-len(data) // ROW)) * ROW)
                image = np.frombuffer(full, np.uint8).reshape(-1, WIDTH, CHANNELS)
                held.append(encode(image, "ppm" if len(image) % 2 else "bmp"))
                sizes.append(len(data))
                size += len(full)
                if size > BATCH or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(held)), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())], ["id", "n_bytes", "media"])
                    held, sizes, at, size = [], [], i + 1, 0

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(trimmed(run), "id long, n_bytes long, media binary")


def read_back(stored: DataFrame) -> DataFrame:
    """stored: id, n_bytes, tiles, dhash. Digests of the samples and of the stored files, all as read from the tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tiles in batch["tiles"]:
                tiles = tiles.as_py()
                data, files = from_tiles(tiles).tobytes(), hashlib.sha256()
                for t in tiles:
                    files.update(t)
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), sum(map(len, tiles)), files.hexdigest()))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["n_bytes"], *cols, batch["dhash"]], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    fields = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.select("id", "n_bytes", "tiles", "dhash").mapInArrow(trimmed(run), fields)


def stored_texts(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Texts as images, decoded, written as a table of NPY tiles, and read back from it."""
    scratch = scratch or Scratch(spark, "media")
    return read_back(scratch.table(media_columns(payload_images(docs, doc_id, text)), "tiles"))
