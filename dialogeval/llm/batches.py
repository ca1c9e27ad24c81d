"""Words of whole Arrow batches as numpy arrays.

A batch is cut into slices of a few MB of text, so memory does not grow with the batch; a text longer than that is a
slice of its own. Words are runs of bytes that a 256-entry table does not map to 0, folded by that table, and are
represented by 64-bit hashes. All positions are bytes of the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
# Words are hashed in blocks of this many bytes, cut at separators.
BLOCK_BYTES = 1 << 18

_TABLES: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(separators: bytes) -> np.ndarray:
    """Folds A-Z to lower case and maps `separators` to 0; the zero byte is a separator too unless it is kept as 1."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[0] = 1 if 0 not in separators else 0
    if 1 not in separators and 0 not in separators:
        table[1] = 255  # bytes that no UTF-8 text holds stand in for the two smallest
    table[list(separators)] = 0
    return table


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 1 << max(18, (n + 1).bit_length())
    if _TABLES.get("size", 0) < size:
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        for name, factor in (("up", base), ("down", inverse)):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            _TABLES[name] = np.multiply.accumulate(powers)
        _TABLES["byte"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        _TABLES["size"] = size
    return _TABLES["up"], _TABLES["down"], _TABLES["byte"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows in them; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges `lo, hi` with the bytes and the row offsets of each, of at most `limit` bytes or one row."""
    data, offsets = text_bytes(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()),
    "array<struct<start:int,end:int>>": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
}


def record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of a schema given as `name type, ...`."""
    fields = [field.strip().split(" ", 1) for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(column, _ARROW[kind.strip()]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


class Words(NamedTuple):
    """`hashes[first[r]:first[r + 1]]` are the words of row `r`; `start` and `end` are bytes of the slice."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _run_hashes(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every run `start:end`; runs are sorted and do not overlap."""
    hashes = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        low = int(start[done])
        upto = max(int(np.searchsorted(end, low + BLOCK_BYTES, side="right")), done + 1)
        high = int(end[upto - 1])
        up, down, letters = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(letters[folded[low:high]] * up[: high - low], out=sums[1:])
        begin, stop = start[done:upto] - low, end[done:upto] - low
        hashes[done:upto] = (sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64)
        done = upto
    return mix(hashes)


def prefixes(data: np.ndarray, found: Words, table: np.ndarray, size: int) -> np.ndarray:
    """Hash of the first `size` code points of every word, or of the whole word."""
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = np.searchsorted(begins, found.start) + size
    end = np.minimum(begins[np.minimum(at, len(begins) - 1)], found.end)
    return _run_hashes(table[data], found.start, end)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of a slice."""
    size = len(data)
    folded = table[data]
    inside = folded != 0
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True  # a row ends a word
    before = np.zeros(size, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:size]))
    after = np.zeros(size, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    return Words(_run_hashes(folded, start, end), first, start, end)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of `k` words, whatever rows they are in; entry i is the run that starts at word i."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x2545F4914F6CDD1D)
        out += hashes[j : n + j]
    return mix(out + np.uint64(k))


def char_positions(data: np.ndarray) -> np.ndarray:
    """Entry b is the number of code points that begin before byte b."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


# The separators of the two kinds of words that the operators know.
WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def white_space_table() -> np.ndarray:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased."""
    return byte_table(WHITE_SPACE)


def word_table() -> np.ndarray:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z was lower-cased."""
    table = byte_table(b"")
    lowered = np.arange(256, dtype=np.uint8)
    lowered[65:91] += 32
    drop = np.zeros(256, bool)
    drop[list(NOT_WORD)] = True
    table[drop[lowered]] = 0
    return table


class Lines(NamedTuple):
    """`new[i]`: word i begins a line; `sentence[i]`: or a sentence; `low`, `high`: bytes of the line of word i."""

    new: np.ndarray
    sentence: np.ndarray
    low: np.ndarray
    high: np.ndarray


def lines(data: np.ndarray, offsets: np.ndarray, found: Words) -> Lines:
    """Lines end at line feeds and rows, sentences also behind a word that ends in a full stop, `!` or `?`."""
    breaks = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    at = np.searchsorted(breaks, found.start, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    sentence = new.copy()
    if len(at):
        sentence[1:] |= np.isin(data[found.end[:-1] - 1], np.frombuffer(b".!?", np.uint8))
    return Lines(new, sentence, breaks[at], breaks[np.minimum(at + 1, len(breaks) - 1)])


def run_hashes(hashes: np.ndarray, begin: np.ndarray, stop: np.ndarray, tag: int) -> np.ndarray:
    """64-bit hash of each run of words `begin:stop`."""
    up, down, _ = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(tag)) * up[: len(hashes)], out=sums[1:])
    return mix((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64) + np.uint64(tag))
