"""Media columns: Netpbm and BMP bytes, area resizing by integral images, NPY tiles, difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import open_fs
from .scratch import materialise, scratch_path

WIDTH = 64
TILE = 32


def encode_netpbm(image: np.ndarray) -> bytes:
    """Binary PGM of a height x width array, PPM of height x width x 3, 8 bits a sample."""
    kind = b"P5" if image.ndim == 2 else b"P6"
    return kind + b"\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + np.ascontiguousarray(image, dtype=np.uint8).tobytes()


def _netpbm_numbers(raw: bytes, at: int, many: int) -> tuple[list[int], int]:
    """Whole numbers between blanks and comments, and where the last one ends."""
    numbers: list[int] = []
    while len(numbers) < many:
        found = _NUMBER.match(raw, at)
        if not found:
            raise ValueError("damaged Netpbm header")
        numbers.append(int(found[1]))
        at = found.end()
    return numbers, at


_NUMBER = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*(\d+)")
_COMMENT = re.compile(rb"#[^\n\r]*")


def read_netpbm(raw: bytes) -> tuple[np.ndarray, int]:
    """PBM, PGM and PPM, plain or binary: samples, and the value that stands for white."""
    kind = raw[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    bits = kind in (b"P1", b"P4")
    numbers, at = _netpbm_numbers(raw, 2, 2 if bits else 3)
    width, height, top = (*numbers, 1)[:3]
    if not 0 < top < 65536 or not width or not height:
        raise ValueError("a Netpbm image without pixels or levels")
    shape = (height, width, 3) if kind in (b"P3", b"P6") else (height, width)
    size = int(np.prod(shape))
    if kind in (b"P1", b"P2", b"P3"):
        body = _COMMENT.sub(b"", raw[at:])
        digits = np.frombuffer(body, dtype=np.uint8) if bits else np.array(body.split()[:size], dtype=np.int64)
        found = digits[(digits == 48) | (digits == 49)][:size] - 48 if bits else digits
    elif bits:
        rows = np.frombuffer(raw, dtype=np.uint8, count=height * ((width + 7) // 8), offset=at + 1).reshape(height, -1)
        found = np.unpackbits(rows, axis=1)[:, :width]
    else:
        found = np.frombuffer(raw, dtype=np.uint8 if top < 256 else ">u2", count=size, offset=at + 1)
    if found.size != size:
        raise ValueError("a Netpbm image that ends early")
    if bits:
        return ((1 - found.astype(np.uint8)) * 255).reshape(shape), 255
    if found.max() > top:
        raise ValueError("a sample above the greatest value")
    return found.astype(np.uint8 if top < 256 else np.uint16).reshape(shape), top


def encode_bmp(image: np.ndarray) -> bytes:
    """Uncompressed BMP: 8-bit grey with a palette, or 24-bit colour."""
    height, width = image.shape[:2]
    grey = image.ndim == 2
    row = width if grey else 3 * width
    pad = -row % 4
    body = np.zeros((height, row + pad), dtype=np.uint8)
    body[:, :row] = (image if grey else image[:, :, ::-1].reshape(height, row))[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1)
    palette[:, 3] = 0
    table = palette.tobytes() if grey else b""
    start = 14 + 40 + len(table)
    head = struct.pack("<2sIHHI", b"BM", start + body.size, 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if grey else 24, 0, body.size, 2835, 2835, 256 if grey else 0, 0)
    return head + info + table + body.tobytes()


def _run_lengths(raw: bytes, at: int, width: int, height: int, depth: int) -> np.ndarray:
    """Palette numbers of an RLE8 or RLE4 body, first row at the bottom; pixels that are skipped are 0."""
    out = np.zeros((height, width), dtype=np.uint8)
    x = y = 0
    nibbles = lambda data: np.stack((np.frombuffer(data, np.uint8) >> 4, np.frombuffer(data, np.uint8) & 15), axis=1).ravel()
    while y < height:
        count, value = raw[at : at + 2]
        at += 2
        if count:
            run = np.resize(nibbles(bytes([value])), count) if depth == 4 else np.full(count, value, np.uint8)
        elif value == 0:
            x, y = 0, y + 1
            continue
        elif value == 1:
            break
        elif value == 2:
            x, y = x + raw[at], y + raw[at + 1]
            at += 2
            continue
        else:
            size = (value + 1) // 2 if depth == 4 else value
            data = raw[at : at + size]
            run = nibbles(data)[:value] if depth == 4 else np.frombuffer(data, np.uint8)
            at += size + size % 2
        room = max(0, width - x)
        out[y, x : x + len(run[:room])] = run[:room]
        x += len(run)
    return out


def _channel(pixels: np.ndarray, mask: int) -> np.ndarray:
    """The bits of a mask, stretched to 0..255."""
    if not mask:
        return np.zeros(pixels.shape, dtype=np.uint8)
    low = (mask & -mask).bit_length() - 1
    top = mask >> low
    return np.rint((pixels & np.uint32(mask)).astype(np.float64) / (1 << low) * 255 / top).astype(np.uint8)


def decode_bmp(raw: bytes) -> np.ndarray:
    """BMP of 1, 4, 8, 16, 24 or 32 bits, run lengths and bit fields too, bottom-up or top-down; grey palettes give two dimensions."""
    if raw[:2] != b"BM":
        raise ValueError("not a BMP image")
    start, info, width, height = struct.unpack_from("<IIii", raw, 10)
    depth, packing = struct.unpack_from("<HI", raw, 28)
    rows = abs(height)
    if info < 40 or depth not in (1, 4, 8, 16, 24, 32) or packing not in (0, 1, 2, 3, 6) or width <= 0 or not rows:
        raise ValueError("a kind of BMP that is not read")
    if packing in (1, 2):
        index = _run_lengths(raw, start, width, rows, depth)
    else:
        stride = (width * depth + 31) // 32 * 4
        body = np.frombuffer(raw, dtype=np.uint8, count=rows * stride, offset=start).reshape(rows, stride)
        if depth >= 24 and packing == 0:
            body = body[:, : width * depth // 8].reshape(rows, width, depth // 8)[:, :, 2::-1]
            return body if height < 0 else body[::-1]
        if depth in (16, 32):
            pixels = np.ascontiguousarray(body[:, : width * depth // 8]).view("<u2" if depth == 16 else "<u4").astype(np.uint32)
            masks = struct.unpack_from("<III", raw, 54) if packing in (3, 6) else (0x7C00, 0x3E0, 0x1F)
            image = np.stack([_channel(pixels, m) for m in masks], axis=2)
            return image if height < 0 else image[::-1]
        index = body[:, :width]
        if depth < 8:
            shifts = np.arange(8 - depth, -1, -depth)
            index = (body[:, :, None] >> shifts & (1 << depth) - 1).reshape(rows, -1)[:, :width]
    index = index if height < 0 and packing == 0 else index[::-1]
    colours = struct.unpack_from("<I", raw, 46)[0] or 1 << depth
    palette = np.frombuffer(raw, dtype=np.uint8, count=4 * colours, offset=14 + info).reshape(-1, 4)
    if index.max() >= colours:
        raise ValueError("a colour that is not in the palette")
    if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all():
        return palette[index, 0]
    return palette[index][:, :, 2::-1]


def read_image(raw: bytes) -> tuple[np.ndarray, int]:
    """Samples of a Netpbm or BMP image, and the value that stands for white.  ValueError for what is none or damaged."""
    try:
        return (decode_bmp(raw), 255) if raw[:2] == b"BM" else read_netpbm(raw)
    except (IndexError, struct.error, OverflowError, MemoryError) as error:
        raise ValueError(f"damaged image: {error}") from error


def decode(raw: bytes) -> np.ndarray:
    return read_image(raw)[0]


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the source area below each target pixel.

    The integral image, read between its grid points by linear interpolation,
    gives exact sums over fractional rectangles, so enlarging works as well.
    """
    if image.ndim == 3:
        return np.stack([area_resize(image[:, :, c], height, width) for c in range(image.shape[2])], axis=2)
    rows = np.linspace(0, image.shape[0], height + 1)
    cols = np.linspace(0, image.shape[1], width + 1)
    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    total[1:, 1:] = image.cumsum(axis=0, dtype=np.float64).cumsum(axis=1)
    at = np.minimum(rows.astype(int), image.shape[0] - 1)
    total = total[at] + (total[at + 1] - total[at]) * (rows - at)[:, None]
    at = np.minimum(cols.astype(int), image.shape[1] - 1)
    total = total[:, at] + (total[:, at + 1] - total[:, at]) * (cols - at)[None, :]
    cells = np.diff(np.diff(total, axis=0), axis=1)
    return cells / (np.diff(rows)[:, None] * np.diff(cols)[None, :])


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image[:, :, :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray, size: int = 8) -> str:
    """Hex of the bits 'left is brighter than right' of a size x (size + 1) reduction."""
    small = area_resize(grey(image), size, size + 1)
    return np.packbits(small[:, :-1] > small[:, 1:] + 1e-9).tobytes().hex()


def npy_bytes(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, image)
    return out.getvalue()


def tile(image: np.ndarray, size: int = TILE, top: int = 255) -> np.ndarray:
    """The image in grey, ``size`` pixels square, with ``top`` as 255."""
    return np.clip(np.rint(area_resize(grey(image), size, size) * (255 / top)), 0, 255).astype(np.uint8)


def text_raster(text: str | None) -> tuple[int, np.ndarray]:
    """UTF-8 length of a text and its bytes, padded with zeros to rows of 64, at least one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    rows = max(1, -(-len(raw) // WIDTH))
    return len(raw), np.frombuffer(raw.ljust(rows * WIDTH, b"\0"), dtype=np.uint8).reshape(rows, WIDTH)


def _encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in source:
        for at in range(0, part.num_rows, 512):
            here = part.slice(at, 512)
            made = [text_raster(t.as_py()) for t in here.column(1)]
            yield pa.RecordBatch.from_arrays(
                [here.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([encode_netpbm(a) for _, a in made], pa.binary())],
                ["doc_id", "n_bytes", "media"],
            )


FEATURES = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, tile_sha256 string, tile_file string, tile_row long, error string"
)


def _features(folder: str):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FEATURES.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in FEATURES.split(", ")]
        fs, root = open_fs(folder)
        for part in source:
            rows, tiles, name = [], [], f"tiles-{uuid.uuid4().hex}.npy"
            for doc, n, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                raw = raw.as_py()
                stored = (None, None) if raw is None else (len(raw), hashlib.sha256(raw).hexdigest())
                try:
                    image, top = read_image(raw or b"")
                except ValueError as error:
                    rows.append((doc, n, None, None, None, *stored, None, None, None, None, str(error)))
                    continue
                payload = image.tobytes()
                tiles.append(tile(image, top=top))
                rows.append(
                    (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *stored,
                     difference_hash(image), hashlib.sha256(npy_bytes(tiles[-1])).hexdigest(), name, len(tiles) - 1, None)
                )
            if tiles:
                fs.create_dir(root, recursive=True)
                with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(npy_bytes(np.stack(tiles)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return run


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: whole texts as 64 pixels wide PGM images, stored and reread.

    Null and empty texts are one row of zeros, null ids and repeated rows are
    stored as they are, extra columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialise(narrow.mapInArrow(_encode, "doc_id long, n_bytes long, media binary"), "media", compression="zstd")


def media_features(media: DataFrame, tiles: str | None = None) -> DataFrame:
    """Decode every image, write its tile, hash it.

    ``media``: doc_id, n_bytes, media (Netpbm or BMP).  Tiles of 32 x 32 go to
    NPY stacks below ``tiles``; ``tile_file`` and ``tile_row`` say where.  A
    retried task writes a new stack and the rows name that one.  What is no
    image, or a damaged or null one, has no features but an ``error``.
    """
    folder = tiles or scratch_path(media.sparkSession, "tiles")
    return materialise(media.select("doc_id", "n_bytes", "media").mapInArrow(_features(folder), FEATURES), "features")
