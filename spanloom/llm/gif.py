"""Media columns: GIF frames with timing and colour histograms.

``encode`` stores 8-bit samples as the colour indices of a GIF: rows of
``WIDTH`` samples, tiles of at most ``ROWS`` rows, one tile for each frame.
``decode`` reads any GIF87a or GIF89a: it follows the LZW code streams, takes
local or global palettes, undoes interlacing, and composes frames on the canvas
under their disposal methods (keep, restore to background, restore to previous)
and transparent index.  A decoded frame has its delay, its rectangle, its own
indices and the canvas in RGBA.

Sizes of codes depend only on how many codes came since the last clear code, so
numpy cuts a whole segment of a code stream into codes at once; what a code
stands for is looked up code by code.

``store_media`` writes the GIFs to the shared folder; ``media_columns`` and
``media_frames`` read the stored bytes back.

Defined cases: a null or empty text is 64 zero bytes.  Texts of any length make
as many frames as they need.  Equal texts give equal bytes.  A null id is kept as
null; repeated rows are stored each for itself.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import full_text, materialize, own_id, plain_id, table

WIDTH = 64
ROWS = 1024
DELAY = 4
BINS = 8
GREYS = bytes(x for i in range(256) for x in (i, i, i))
CLEAR, END, FIRST, FULL = 256, 257, 258, 4096


def _code_sizes(n: int, least: int) -> np.ndarray:
    """Bits of n codes after a clear code; each code but the first adds to the table."""
    known = (1 << least) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.minimum(np.maximum(least + 1, np.ceil(np.log2(known + 1)).astype(np.int64)), 12)


def _classes(least: int) -> list[tuple[int, int, int, int]]:
    """(first, last + 1, bits, position of the first's lowest bit) of each run of codes of one size."""
    sizes, out, at = _code_sizes(FULL + 2, least), [], 0
    for n in range(least + 1, 13):
        k = np.flatnonzero(sizes == n)
        if len(k):
            out.append((int(k[0]), int(k[-1]) + 1, n, at))
            at += len(k) * n
    return out


_ENDS = {least: np.cumsum(_code_sizes(FULL + 2, least)) for least in range(2, 9)}
_CLASSES = {least: _classes(least) for least in range(2, 9)}


def _to_bits(codes: list[int]) -> list[np.ndarray]:
    """The bits of a segment's codes, lowest first, as arrays of 0 and 1."""
    wide = np.unpackbits(np.array(codes, "<u2").view(np.uint8), bitorder="little").reshape(-1, 16)
    return [wide[a:b, :n].ravel() for a, b, n, _ in _CLASSES[8] if a < len(codes)]


def _to_codes(bits: np.ndarray, at: int, count: int, least: int) -> list[int]:
    """The first codes of the segment that begins at a bit."""
    out = []
    for a, b, n, first in _CLASSES[least]:
        k = min(b, count) - a
        if k <= 0:
            break
        wide = np.zeros((k, 16), np.uint8)
        wide[:, :n] = bits[at + first : at + first + k * n].reshape(k, n)
        out += np.packbits(wide, axis=1, bitorder="little").view("<u2").ravel().tolist()
    return out


def lzw_encode(data: bytes) -> bytes:
    """GIF's LZW with eight-bit samples; a clear code whenever the table is full."""
    out, at, n = [*_to_bits([CLEAR])], 0, len(data)
    while at < n:
        codes: list[int] = []
        add = codes.append
        known: dict[int, int] = {}
        find = known.get
        new, prefix = FIRST, data[at]
        at += 1
        while at < n:
            block = data[at : at + 8192]
            for i, b in enumerate(block):
                key = prefix << 8 | b
                k = find(key)
                if k is not None:
                    prefix = k
                    continue
                add(prefix)
                prefix = b
                if new == FULL - 1:
                    at += i
                    break
                known[key] = new
                new += 1
            else:
                at += len(block)
                continue
            break
        else:
            add(prefix)
            codes.append(END)
            out += _to_bits(codes)
            break
        codes.append(CLEAR)
        out += _to_bits(codes)
    if not n:
        out += _to_bits([END])
    return np.packbits(np.concatenate(out), bitorder="little").tobytes()


def lzw_decode(data: bytes, least: int, n: int) -> bytes:
    """At most n samples of a GIF code stream whose least code size is ``least``."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    clear, end = 1 << least, (1 << least) + 1
    single = [bytes([i]) for i in range(clear)] + [b"", b""]
    ends = _ENDS[least]
    weights = 1 << np.arange(12)
    out: list[bytes] = []
    made, at, wanted = 0, 0, FULL
    while made < n and at < len(bits):
        if len(bits) - at > least and not bits[at : at + least].any() and bits[at + least]:
            at += least + 1  # a clear code at a segment's head
            continue
        whole = int(np.searchsorted(ends, len(bits) - at, side="right"))
        count = min(whole, wanted)
        if not count:
            break
        span = int(ends[count - 1])
        codes = _to_codes(bits, at, count, least)
        known = list(single)
        add, put = known.append, out.append
        last = None
        for i, code in enumerate(codes):
            if code == clear:
                at += int(ends[i])
                break
            if code == end:
                return b"".join(out)[:n]
            if last is None:
                last = known[code]
                put(last)
                continue
            if code < len(known):
                entry = known[code]
                if len(known) < FULL:
                    add(last + entry[:1])
            else:
                entry = last + last[:1]
                add(entry)
            put(entry)
            last = entry
        else:  # a table that stays full: its codes all have twelve bits
            at += span
            while at + 12 <= len(bits):
                code = int(bits[at : at + 12] @ weights)
                at += 12
                if code == clear:
                    break
                if code == end:
                    return b"".join(out)[:n]
                put(known[code] if code < len(known) else last + last[:1])
                last = out[-1]
            if at + 12 > len(bits):
                break
        made = sum(map(len, out)) if len(out) > 64 else made
    return b"".join(out)[:n]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def padded(text: str) -> tuple[bytes, int]:
    """The text's bytes with zeros up to a positive multiple of WIDTH; how many were its own."""
    own = text.encode("utf-8", "surrogatepass")
    return own + bytes(WIDTH - len(own) if len(own) < WIDTH else -len(own) % WIDTH), len(own)


def encode(payload: bytes) -> bytes:
    """A GIF89a whose frames' indices, one after another, are the payload."""
    rows = len(payload) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), GREYS]
    for top in range(0, rows, ROWS):
        tile = payload[top * WIDTH : (top + ROWS) * WIDTH]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, DELAY, 0), b"\0", struct.pack("<BHHHHB", 0x2C, 0, 0, WIDTH, len(tile) // WIDTH, 0), b"\x08", _blocks(lzw_encode(tile))]
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    indices: np.ndarray
    palette: np.ndarray

    def histogram(self, bins: int = BINS) -> np.ndarray:
        """Visible samples by brightness of their colour."""
        shades = self.palette.astype(np.int64) @ np.array([299, 587, 114]) // 1000 * bins // 256
        own = np.bincount(self.indices.ravel(), minlength=256)
        if self.transparent is not None:
            own[self.transparent] = 0
        return np.bincount(shades, own[: len(shades)], bins).astype(np.int64)


def frames(data: bytes) -> tuple[int, int, int, list[Frame]]:
    """(width, height, background index, frames) of a GIF."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, packed, background, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13

    def colours(packed: int) -> np.ndarray | None:
        nonlocal at
        if not packed & 0x80:
            return None
        n = 3 << (packed & 7) + 1
        at += n
        return np.frombuffer(data, np.uint8, n, at - n).reshape(-1, 3)

    def sub_blocks() -> bytes:
        nonlocal at
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        at += 1
        return b"".join(parts)

    shared, out, delay, disposal, transparent = colours(packed), [], 0, 0, None
    while at < len(data) and data[at] != 0x3B:
        kind = data[at]
        at += 1
        if kind == 0x21:
            label = data[at]
            at += 1
            body = sub_blocks()
            if label == 0xF9:
                flags, delay, index = struct.unpack_from("<BHB", body)
                disposal, transparent = flags >> 2 & 7, index if flags & 1 else None
        elif kind == 0x2C:
            left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at)
            at += 9
            own = colours(flags)
            least = data[at]
            at += 1
            pixels = np.frombuffer(lzw_decode(sub_blocks(), least, w * h).ljust(w * h, b"\0"), np.uint8).reshape(h, w)
            if flags & 0x40:
                order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
                straight = np.empty_like(pixels)
                straight[order] = pixels
                pixels = straight
            palette = own if own is not None else shared if shared is not None else np.frombuffer(GREYS, np.uint8).reshape(-1, 3)
            out.append(Frame(left, top, w, h, delay, disposal, transparent, pixels, palette))
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError("not a GIF block")
    return width, height, background, out


def canvases(width: int, height: int, own: list[Frame]) -> Iterator[np.ndarray]:
    """The RGBA canvas as each frame shows it."""
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in own:
        before = canvas.copy() if f.disposal == 3 else None
        area = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        pixels = f.indices[: area.shape[0], : area.shape[1]]
        seen = np.ones(pixels.shape, bool) if f.transparent is None else pixels != f.transparent
        colours = np.zeros((256, 4), np.uint8)
        colours[: len(f.palette), :3], colours[:, 3] = f.palette, 255
        area[seen] = colours[pixels[seen]]
        yield canvas.copy()
        if f.disposal == 2:
            area[:] = 0
        elif f.disposal == 3:
            canvas = before


def frame_rows(data: bytes) -> list[dict]:
    """Timed frames: when and how long each shows, its rectangle, the brightness histogram of
    its own visible samples and that of the canvas as it shows (samples never painted left out)."""
    width, height, _, own = frames(data)
    out, at = [], 0
    for k, (f, canvas) in enumerate(zip(own, canvases(width, height, own), strict=True)):
        seen = canvas[canvas[:, :, 3] > 0][:, :3].astype(np.int64) @ np.array([299, 587, 114]) // 1000 * BINS // 256
        out.append({"frame": k, "at_ms": at, "delay_ms": 10 * f.delay, "left": f.left, "top": f.top, "width": f.width, "height": f.height, "histogram": f.histogram().tolist(), "canvas_histogram": np.bincount(seen, minlength=BINS).tolist()})
        at += 10 * f.delay
    return out


STORED = "doc_id long, no_id boolean, n_bytes long, media binary"
FRAME = "struct<frame:int,at_ms:long,delay_ms:long,left:int,top:int,width:int,height:int,histogram:array<long>,canvas_histogram:array<long>>"
MEDIA = "doc_id long, no_id boolean, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, duration_ms long"


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, no_id, n_bytes, media: each text as a GIF, written to the shared folder and read again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            payloads = [padded(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "n_bytes": [n for _, n in payloads], "media": [encode(p) for p, _ in payloads]})

    return materialize(docs.select(*plain_id(), full_text().alias("text")).mapInPandas(run, STORED), "media")


def media_frames(stored: DataFrame) -> DataFrame:
    """doc_id and ``frame_rows`` of each stored GIF, a row for each frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"], "f": [frame_rows(m) for m in b["media"]]})

    found = stored.mapInPandas(run, f"doc_id long, no_id boolean, f array<{FRAME}>")
    return found.select(own_id(), F.explode("f").alias("f")).select("doc_id", "f.*")


def media_columns(stored: DataFrame) -> DataFrame:
    """doc_id, digests of each stored GIF and of the payload read back from it, feature
    (brightness histogram of all frames), frames, duration."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, no_id, n, media in zip(b["doc_id"].tolist(), b["no_id"].tolist(), b["n_bytes"].tolist(), b["media"], strict=True):
                _, _, _, own = frames(media)
                back = b"".join(f.indices.tobytes() for f in own)
                histogram = sum(f.histogram() for f in own)
                rows.append((doc_id, no_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), ",".join(map(str, histogram.tolist())), len(own), 10 * sum(f.delay for f in own)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEDIA.split(", ")])

    found = stored.mapInPandas(run, MEDIA)
    return found.select(own_id(), *(c for c in found.columns if c not in ("doc_id", "no_id")))


def op6_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(store_media(table(spark, sf_dir, "documents")))
