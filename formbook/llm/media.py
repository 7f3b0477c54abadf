"""Media columns: GIF files with LZW code streams, palettes, disposal and transparency.

``encode_gif`` stores 8-bit samples as timed frames. The palette holds the grey levels that occur, so that codes start
as narrow as they can. A frame that repeats a part of the one before is drawn over it, with the repeated samples
transparent, where that makes the file shorter; before any other frame the canvas is disposed to the background. ``decode_gif`` reads any
GIF: it follows the variable-width LZW codes through the dictionary, undoes interlacing, applies global and local
palettes, transparency and the disposal of each frame, and yields the timed canvases.
``frames`` turns a table of GIFs into a table of frames with colour-histogram columns.

Scale: files are independent, so the work is a map without a shuffle; a task holds
one file's canvas at a time. Long payloads are cut into frames of bounded height. ``media_report`` writes the files
as a table in the shared folder and works on what it reads back.

Edge cases: a null payload is empty and still has one row of samples; a file that is no GIF, or
is broken off, yields the frames before the fault; null files yield none; repeated rows are
decoded alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

#: Samples per row, rows per frame, hundredths of a second per frame.
WIDTH, HEIGHT, DELAY = 64, 32, 10
#: Part of a frame's samples that repeat those before, from which on drawing over them is tried.
REPEATED = 0.2
#: Fixed value: codes of a GIF stream have 12 bits at most.
MOST_CODES = 4096


@dataclass
class Frame:
    start_ms: int
    delay_ms: int
    box: tuple[int, int, int, int]  # left, top, width, height of what this frame drew
    canvas: np.ndarray  # height x width x 4, RGBA


def lzw_encode(samples: bytes, min_size: int) -> bytes:
    """LZW code stream of samples below 2**min_size; the dictionary grows to 4096 codes, then starts anew."""
    clear = 1 << min_size
    first = clear + 2
    codes, table, fresh = [clear], {}, first
    put, find = codes.append, table.get
    it = iter(samples)
    prefix = next(it)
    for s in it:
        key = prefix << 8 | s
        code = find(key)
        if code is not None:
            prefix = code
            continue
        put(prefix)
        prefix = s
        table[key] = fresh
        fresh += 1
        if fresh == MOST_CODES:
            put(clear)
            table.clear()
            fresh = first
    codes += [prefix, clear + 1]
    # Widths follow from the place behind the last clear code: the dictionary grows by one with each code.
    since = np.arange(len(codes) - 1) % (MOST_CODES - first + 1)
    sizes = np.concatenate([[min_size + 1], _reading(min_size + 1)[0][since]])
    value = np.array(codes, np.int64) << ((ends := np.cumsum(sizes)) - sizes & 7)
    at = ends - sizes >> 3
    length = int(ends[-1] + 7 >> 3)
    out = sum(np.bincount(at + i, value >> 8 * i & 255, length + 2) for i in range(3))  # codes share bytes, not bits
    return out[:length].astype(np.uint8).tobytes()


@cache
def _reading(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the codes behind a clear code whose first has ``width`` bits, and where they end."""
    sizes = np.array([min(12, max(width, ((1 << width - 1) + 1 + j).bit_length())) for j in range(MOST_CODES)], np.int64)
    return sizes, np.cumsum(sizes)


def lzw_decode(data: bytes, min_size: int, wanted: int) -> bytes:
    """Samples of an LZW stream, one run between clear codes after the other; a faulty code ends it."""
    clear, parts, got = 1 << min_size, [], 0
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    bits, at, run, ended = 8 * len(data), 0, [], False
    while not ended and got < wanted:
        sizes, ends = _reading(12 if run else min_size + 1)  # a full dictionary may stay in use
        many = int(np.searchsorted(ends, bits - at, "right"))
        sizes, ends = sizes[:many], ends[:many] + at
        place = ends - sizes
        low = place >> 3
        codes = (raw[low] + raw[low + 1] * np.int64(256) + raw[low + 2] * np.int64(65536)) >> (place & 7) & ((1 << sizes) - 1)
        stops = np.flatnonzero(codes >> 1 == clear >> 1)[:1]  # clear or end code
        run.append(codes[: int(stops[0])] if stops.size else codes)
        at = int(ends[int(stops[0]) if stops.size else -1]) if many else at
        ended = many < MOST_CODES and not stops.size or stops.size > 0 and codes[stops[0]] == clear + 1
        if stops.size or ended:
            found, whole = _entries(np.concatenate(run) if len(run) > 1 else run[0], clear)
            parts.append(found)
            got += len(found)
            run, ended = [], ended or not whole
    return b"".join(parts)[:wanted]


def _entries(codes: np.ndarray, clear: int) -> tuple[bytes, bool]:
    """What a run of codes stands for, and whether all of them are valid.

    The run itself is its dictionary: entry k is code k followed by the first sample of code k + 1. All codes walk up
    their entries together, a step for each sample of the longest.
    """
    first = clear + 2
    place = np.arange(len(codes))
    wrong = np.flatnonzero(codes - first >= place)
    valid = int(wrong[0]) if wrong.size else len(codes)
    codes = codes[:valid]
    root = codes.copy()
    while (deep := np.flatnonzero(root >= first)).size:
        root[deep] = codes[root[deep] - first]
    follows = np.append(root[1:], 0)
    size, here, which = np.zeros(valid, np.int64), codes, place[:valid]
    steps = []
    while which.size:
        size[which] += 1
        inner = here >= first
        entry = np.where(inner, here - first, 0)
        steps.append((which, np.where(inner, follows[entry], here)))
        which, here = which[inner], codes[entry[inner]]
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if valid else 0, np.uint8)
    for back, (which, sample) in enumerate(steps, 1):
        out[ends[which] - back] = sample
    return out.tobytes(), not wrong.size


def encode_gif(payload: bytes, width: int = WIDTH, height: int = HEIGHT, delay: int = DELAY) -> bytes:
    """payload: a positive multiple of ``width`` bytes."""
    levels = np.flatnonzero(np.bincount(np.frombuffer(payload, np.uint8), minlength=256))
    size = max(2, min(8, int(len(levels)).bit_length()))  # room for one index that no sample has, where there can be one
    hollow = len(levels) if len(levels) < 1 << size else None
    index = np.zeros(256, np.uint8)
    index[levels] = np.arange(len(levels))
    drawn = payload.translate(index.tobytes())
    grey = np.zeros((1 << size, 3), np.uint8)
    grey[: len(levels)] = levels[:, None]
    step = width * height
    cuts = [drawn[i : i + step] for i in range(0, len(drawn), step)]
    streams = [lzw_encode(c, size) for c in cuts]
    over = [False] * (len(cuts) + 1)  # whether a frame is drawn over the one before
    for i in range(1, len(cuts) if hollow is not None else 0):
        here = np.frombuffer(cuts[i], np.uint8)
        same = here == np.frombuffer(cuts[i - 1], np.uint8)[: len(here)]
        if same.mean() >= REPEATED:
            shorter = lzw_encode(np.where(same, np.uint8(hollow), here).tobytes(), size)
            over[i] = len(shorter) < len(streams[i])
            streams[i] = min(streams[i], shorter, key=len)
    parts = [b"GIF89a", struct.pack("<HHBBB", width, len(cuts[0]) // width, 0xF0 | size - 1, 0, 0), grey.tobytes()]
    for i, stream in enumerate(streams):
        disposal = 1 if over[i + 1] else 2
        parts.append(b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | over[i], delay, hollow or 0) + b"\x00\x2c" + struct.pack("<HHHHB", 0, 0, width, len(cuts[i]) // width, 0) + bytes([size]))
        parts += [bytes([len(block)]) + block for j in range(0, len(stream), 255) if (block := stream[j : j + 255])]
        parts.append(b"\x00")
    return b"".join([*parts, b"\x3b"])


def decode_gif(data: bytes | None) -> Iterator[Frame]:
    """The timed canvases of a GIF."""
    if not data or data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13

    def palette(flags: int, at: int) -> tuple[np.ndarray | None, int]:
        if not flags & 0x80:
            return None, at
        n = 2 << (flags & 7)
        return np.frombuffer(data[at : at + 3 * n].ljust(3 * n, b"\0"), np.uint8).reshape(n, 3), at + 3 * n

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while at < len(data) and (n := data[at]):
            parts.append(data[at + 1 : at + 1 + n])
            at += n + 1
        return b"".join(parts), at + 1

    shared, at = palette(flags, at)
    canvas = np.zeros((height, width, 4), np.uint8)
    clock, disposal, delay, transparent = 0, 0, 0, None
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            body, end = blocks(at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, 10 * struct.unpack_from("<H", body, 1)[0]
                transparent = body[3] if body[0] & 1 else None
            at = end
            continue
        if data[at] != 0x2C or at + 10 >= len(data):
            return
        left, top, w, h, own = struct.unpack_from("<HHHHB", data, at + 1)
        colours, at = palette(own, at + 10)
        colours = shared if colours is None else colours
        if at >= len(data) or not 1 <= data[at] <= 11:
            return
        size = data[at]
        stream, at = blocks(at + 1)
        samples = np.frombuffer(lzw_decode(stream, size, w * h).ljust(w * h, b"\0"), np.uint8).reshape(h, w)
        if own & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(samples)
            straight[order] = samples
            samples = straight
        if colours is None:
            colours = np.zeros((256, 3), np.uint8)
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        seen = samples[: area.shape[0], : area.shape[1]]
        opaque = np.full((256, 4), 255, np.uint8)
        opaque[: len(colours), :3] = colours
        opaque[len(colours) :, :3] = colours[-1]
        rgba = opaque[seen]
        if transparent is None:
            area[:] = rgba
        else:
            np.copyto(area, rgba, where=(seen != transparent)[..., None])
        yield Frame(clock, delay, (left, top, w, h), canvas.copy())
        clock += delay
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas = before
        disposal, delay, transparent = 0, 0, None


def histogram(frame: Frame, bins: int = 16) -> list[int]:
    """Pixels of what the frame drew, by luminance."""
    left, top, w, h = frame.box
    rgb = frame.canvas[top : top + h, left : left + w, :3].astype(np.uint32)
    light = (rgb[..., 0] * 299 + rgb[..., 1] * 587 + rgb[..., 2] * 114) // 1000
    return np.bincount((light * bins // 256).ravel(), minlength=bins).tolist()


FRAMES = "media_id long, frame int, start_ms long, delay_ms long, width int, height int, rgba binary, histogram array<long>"


def frames(files: DataFrame, *, id_col: str = "media_id", media_col: str = "media") -> DataFrame:
    """One row for each frame of each GIF."""
    ship(files.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("media_id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("rgba", pa.binary()), ("histogram", pa.list_(pa.int64()))])
        for batch in batches:
            for key, media in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for i, f in enumerate(decode_gif(media.as_py())):
                    row = [key, i, f.start_ms, f.delay_ms, f.canvas.shape[1], f.canvas.shape[0], f.canvas.tobytes(), histogram(f)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

    return files.select(F.col(id_col).cast("long"), F.col(media_col)).mapInArrow(of, FRAMES)


def stored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", extra: str | None = None) -> DataFrame:
    """(media_id, [extra,] media): every text as a GIF."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                media = [encode_gif(payload_of(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(media, pa.binary())], [*batch.schema.names[:-1], "media"])

    slim = docs.select(F.col(id_col).cast("long").alias("media_id"), *([F.col(extra).cast("long")] if extra else []), F.col(text_col))
    return slim.mapInArrow(of, "media_id long, " + (f"{extra} long, " if extra else "") + "media binary")


def payload_of(text: str | None, unit: int = WIDTH) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(unit, -(-len(raw) // unit) * unit), b"\0")


SHOWN = "array<struct<frame: int, start_ms: bigint, delay_ms: bigint, width: int, height: int, histogram: array<bigint>>>"
REPORT = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames {SHOWN}"


def media_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a GIF, read the stored bytes back, and compute features from the frames that they show."""
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kept = materialize(stored(sized, extra="n_bytes"), "media")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import zlib

        fields = [("frame", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("histogram", pa.list_(pa.int64()))]
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2 + [pa.string(), pa.list_(pa.struct(fields))]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "frames"]
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                rows, batch = [], whole.slice(at, 500)
                for doc, n, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    media = media.as_py()
                    parts, shown = [], []
                    for i, f in enumerate(decode_gif(media)):
                        left, top, w, h = f.box
                        parts.append(f.canvas[top : top + h, left : left + w, 0].tobytes())  # grey: red is the sample
                        shown.append({"frame": i, "start_ms": f.start_ms, "delay_ms": f.delay_ms, "width": w, "height": h, "histogram": histogram(f)})
                    back = b"".join(parts)
                    rows.append((doc, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), shown))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names)

    out = kept.mapInArrow(of, REPORT)
    bars = F.aggregate("frames", F.array_repeat(F.lit(0).cast("long"), 16), lambda a, f: F.zip_with(a, f["histogram"], lambda x, y: x + y))
    shown = F.aggregate("frames", F.lit(0).cast("long"), lambda a, f: a + f["delay_ms"])
    feature = F.concat(F.lit("frames="), F.size("frames").cast("string"), F.lit(";ms="), shown.cast("string"), F.lit(";hist="), F.array_join(F.transform(bars, lambda x: x.cast("string")), "/"))
    return out.select(*[c for c in out.columns if c != "frames"], feature.alias("feature"), "frames")
