"""Fill-in-the-middle by displacement scatter: every byte of a batch gets the shift by which it moves, and moves at once.

The texts of a batch stand behind each other as UTF-8 bytes. A scan for line ends gives the cuts of each text. At the cuts
(and at each start) a difference array notes by how much the shift changes; its cumulative sum is the shift of every byte,
and one scatter puts all bytes where they belong, around the three marks. The way back scans the outputs for the marks,
builds the differences of the opposite shift and gathers. Neither way loops over bytes or lines.

Texts are cut into lines, each with its line end; the two cuts fall between lines and derive from the sha256 of the salt and
doc_id, so reruns and other partitions give the same result.

Defined results: text null or empty is plain with no lines; a text that already holds a mark stays plain; a null doc_id
counts as empty behind the salt. Rows that repeat are transformed alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora.llm.cut import bounded_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text that are handled at a time (a longer text is handled alone), and bytes whose shifts are held at a time.
CHUNK = 1 << 22
SLICE = 1 << 20

_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a string column (null: empty) as bytes and n + 1 offsets that start at 0."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data))


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `CHUNK` bytes of the column each; at least one row."""
    ends = _bytes(batch.column(column))[1][1:]
    start = done = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def found_at(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Start of every occurrence of the mark, ascending."""
    if len(data) < len(mark):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:len(data) - len(mark) + 1] == mark[0])
    for k, byte in enumerate(mark[1:], 1):
        at = at[data[at + k] == byte]
    return at


def _inside(at: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The text of each start, -1 where `width` bytes from there cross into the next text."""
    owner = np.searchsorted(offsets, at, "right") - 1
    return np.where(at + width <= offsets[owner + 1], owner, -1)


def _shifts(at: np.ndarray, change: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The cumulative sum of a difference array, slice by slice: (from, to, shift of each byte)."""
    order = np.argsort(at, kind="stable")
    at, change = at[order], change[order]
    carry = 0
    for start in range(0, size, SLICE):
        stop = min(size, start + SLICE)
        a, b = np.searchsorted(at, [start, stop])
        step = np.zeros(stop - start, np.int64)
        np.add.at(step, at[a:b] - start, change[a:b])
        step[0] += carry
        shift = np.cumsum(step)
        carry = int(shift[-1])
        yield start, stop, shift


def _ordered_changes(starts: list[np.ndarray], shifts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Difference array of shifts that hold from the given starts on (one row of segments for each text)."""
    at, shift = np.stack(starts, axis=1).ravel(), np.stack(shifts, axis=1).ravel()
    return at, np.diff(shift, prepend=0)


def scatter(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, psm: np.ndarray, spm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of a batch of texts, cut at the byte positions first <= second, and their offsets."""
    start, end = offsets[:-1], offsets[1:]
    moved = psm | spm
    sizes = end - start + np.where(moved, 3 * MARK, 0)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    base = out_offsets[:-1] - start
    prefix, middle, suffix = first - start, second - first, end - second
    # psm: <P> prefix <S> suffix <M> middle; spm: <S> suffix <P> prefix <M> middle
    to_prefix = base + np.where(psm, MARK, np.where(spm, 2 * MARK + suffix, 0))
    to_middle = base + np.where(moved, 3 * MARK + suffix, 0)
    to_suffix = base + np.where(psm, 2 * MARK - middle, np.where(spm, MARK - middle - prefix, 0))
    out = np.empty(out_offsets[-1], np.uint8)
    # Where segments are empty, several changes fall on one byte and add up to that of the last.
    for a, b, shift in _shifts(*_ordered_changes([start, first, second], [to_prefix, to_middle, to_suffix]), len(data)):
        out[np.arange(a, b) + shift] = data[a:b]
    top = out_offsets[:-1]
    for mark, places in (
        (PREFIX, np.where(psm, top, top + MARK + suffix)), (SUFFIX, np.where(psm, top + MARK + prefix, top)), (MIDDLE, top + 2 * MARK + prefix + suffix)):
        for k, byte in enumerate(mark):
            out[places[moved] + k] = byte
    return out, out_offsets


def gather(data: np.ndarray, offsets: np.ndarray, psm: np.ndarray, spm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind a batch of outputs, from the outputs and their forms alone."""
    start, end = offsets[:-1], offsets[1:]
    moved = psm | spm
    places = []
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = found_at(data, mark)
        owner = _inside(at, offsets, MARK)
        at, owner = at[owner >= 0], owner[owner >= 0]
        place = start.copy()
        place[owner[::-1]] = at[::-1]  # the first of a text; a text that was moved holds no other
        places.append(place)
    p, s, m = places
    prefix = np.where(psm, s - p - MARK, np.where(spm, m - p - MARK, end - start))
    suffix = np.where(psm, m - s - MARK, np.where(spm, p - s - MARK, 0))
    middle = np.where(moved, end - m - MARK, 0)
    back = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    top = back[:-1]
    from_prefix = np.where(moved, p + MARK, start) - top
    from_middle = np.where(moved, m + MARK, start) - (top + prefix)
    from_suffix = np.where(moved, s + MARK, start) - (top + prefix + middle)
    out = np.empty(back[-1], np.uint8)
    for a, b, shift in _shifts(*_ordered_changes([top, top + prefix, top + prefix + middle], [from_prefix, from_middle, from_suffix]), len(out)):
        out[a:b] = data[np.arange(a, b) + shift]
    return out, back


def _transform(percent: int, spm_percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole, "text"):
                data, offsets = _bytes(batch.column("text"))
                h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
                start, end = offsets[:-1], offsets[1:]
                breaks = np.flatnonzero(data == 10)
                before = np.searchsorted(breaks, offsets)
                full = before[1:] - before[:-1]
                open_line = np.zeros(len(start), np.int64)
                some = end > start
                open_line[some] = data[end[some] - 1] != 10
                n = full + open_line
                marked = np.zeros(len(start), bool)
                for mark in (PREFIX, SUFFIX, MIDDLE):
                    owner = _inside(found_at(data, mark), offsets, MARK)
                    marked[owner[owner >= 0]] = True
                moved = some & ~marked & (h3 % 100 < percent)
                spm = moved & (h4 % 100 < spm_percent)
                psm = moved & ~spm
                a, b = h1 % (n + 1), h2 % (n + 1)
                ends = np.append(breaks + 1, 0)

                def at(unit: np.ndarray) -> np.ndarray:
                    """Byte behind so many lines of a text."""
                    whole_line = np.clip(before[:-1] + unit - 1, 0, len(ends) - 1)
                    return np.where(unit == 0, start, np.where(unit > full, end, ends[whole_line]))

                first, second = at(np.minimum(a, b)), at(np.maximum(a, b))
                later = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                out, out_offsets = scatter(data, offsets, first, second, psm, spm)
                form = np.where(psm, PSM, np.where(spm, SPM, PLAIN))
                plain = ~moved
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), pa.array(later[first] - later[start], pa.int64(), mask=plain),
                    pa.array(later[second] - later[first], pa.int64(), mask=plain), _strings(out, out_offsets)], schema=_OUT)

    return run


def _restore(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _pieces(whole, "output"):
            data, offsets = _bytes(batch.column("output"))
            form = np.array(batch.column("form").to_pylist(), object)
            out, back = gather(data, offsets, form == PSM, form == SPM)
            columns = [c for k, c in enumerate(batch.columns) if batch.schema.names[k] != "restored"]
            names = [k for k in batch.schema.names if k != "restored"]
            yield pa.RecordBatch.from_arrays([*columns, _strings(out, back)], names=[*names, "restored"])


def _draw(key: Column, k: int) -> Column:
    return F.conv(F.substring(key, 8 * k - 7, 8), 16, 10).cast("long").alias(f"h{k}")


def transform(docs: DataFrame, salt: str = "7", percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars (null if plain), output for every row of docs (doc_id, text).

    `percent` of the texts are transformed, of these `spm_percent` with the suffix first.
    """
    bounded_batches(docs)
    doc_id = F.col("doc_id").cast("long")
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    rows = rows.select("doc_id", "text", *[_draw(F.col("key"), k) for k in (1, 2, 3, 4)])
    return rows.mapInArrow(_transform(percent, spm_percent), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """The rows with a further column `restored`: the text, rebuilt from `output` and `form` alone."""
    bounded_batches(transformed)
    names = [c for c in transformed.columns if c != "restored"]
    schema = ", ".join(f"`{c}` {transformed.schema[c].dataType.simpleString()}" for c in names)
    return transformed.mapInArrow(_restore, f"{schema}, restored string")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the sha256 of the output and of the restored text."""
    rows = restore(transform(docs))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
