"""Several values packed in one field: split into one value per row, with the position kept.

The kernel works on the Arrow string buffer of a whole batch: quote parity by a running count, delimiter masks, child
offsets, and a flat child array with the ordinal of each value's parent row.

What counts as a delimiter:

* `;` `|` and `,` outside quotes (and `/` where the caller says so), in any run and with any white space around them;
* a JSON array is read as such (brackets dropped, backslash escapes decoded);
* a comma is part of a name where what follows it, up to the next delimiter, is a tail that quoted values of the same
  field carry after their own comma (`"Foo, Inc."` teaches ` Inc.`). These tails are learned from the whole field;
* `/` does not split where a side of it is a single letter (`N/A`).

Defined cases: null, empty and blank fields give no row; empty pieces are not counted; a field with an odd number of
quotes is split as if quotes were ordinary signs; quotes inside a value stay, doubled quotes inside quoted values become
one; values lose outer white space only. Fields of any length are handled, as the work is per byte of the batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut

QUOTE, COMMA, SLASH, BACKSLASH, OPEN, CLOSE = (ord(c) for c in '",/\\[]')
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Tails are sent to the tasks while there are at most so many, of so many bytes; beyond it they reach the rows by a join.
TAIL_BOUND, TAIL_BYTES = 20_000, 4_000_000


def _trim(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds without outer blanks, for all pieces at once; one pass per blank of the most indented piece."""
    lo = lo.copy()
    todo = np.flatnonzero(lo < hi)
    while todo.size:
        todo = todo[BLANK[buf[lo[todo]]]]
        lo[todo] += 1
        todo = todo[lo[todo] < hi[todo]]
    return lo, _rtrim(buf, lo, hi)


def _rtrim(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Ends without the blanks before them."""
    hi = hi.copy()
    todo = np.flatnonzero(lo < hi)
    while todo.size:
        todo = todo[BLANK[buf[hi[todo] - 1]]]
        hi[todo] -= 1
        todo = todo[lo[todo] < hi[todo]]
    return hi


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The value bytes and the row offsets of a string array, nulls as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def _gather(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """A string array of the given byte ranges."""
    size = hi - lo
    offsets = np.zeros(len(lo) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    index = np.repeat(lo - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(offsets), pa.py_buffer(buf[index].tobytes())).cast(pa.string())


class Marked:
    """The bytes of a batch with its rows' bounds and delimiter marks, before tails bind any comma."""

    def __init__(self, texts: pa.Array, separators: str):
        self.buf, self.offsets = buf, offsets = _bytes_of(texts)
        self.n = n = len(offsets) - 1
        lo, hi = _trim(buf, offsets[:-1], offsets[1:])
        self.as_json = np.zeros(n, bool)
        at = np.flatnonzero(hi - lo >= 2)
        self.as_json[at] = (buf[lo[at]] == OPEN) & (buf[hi[at] - 1] == CLOSE)
        self.lo, self.hi = lo, hi = lo + self.as_json, hi - self.as_json
        self.row_of = row_of = np.repeat(np.arange(n), np.diff(offsets))

        quote = buf == QUOTE
        if self.as_json.any() and (buf == BACKSLASH).any():
            quote &= ~_escaped(buf, offsets, self.as_json)
        running = np.concatenate([[0], np.cumsum(quote)])
        per_row = running[offsets[1:]] - running[offsets[:-1]]
        self.odd = odd = per_row % 2 == 1
        outside = ((running[:-1] - running[offsets[:-1]][row_of]) % 2 == 0) | odd[row_of] if buf.size else np.zeros(0, bool)

        lut = np.zeros(256, bool)
        lut[[ord(c) for c in separators]] = True
        marks = np.flatnonzero(lut[buf] & outside & ~quote) if buf.size else np.zeros(0, np.int64)
        marks = marks[(marks >= lo[row_of[marks]]) & (marks < hi[row_of[marks]])]
        if marks.size and "/" in separators:
            marks = marks[~_single_letters(buf, marks, row_of, lo, hi)]
        self.marks = marks

    def spans(self, most: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(index of the comma's mark, number of commas, start, end) of all that may be a tail: what follows a comma, up to
        the next mark, or further over at most `most` commas in a row; `first` masks the bytes a tail begins with."""
        marks, rows, buf = self.marks, self.row_of[self.marks], self.buf
        comma = buf[marks] == COMMA
        at = np.flatnonzero(comma & (marks + 1 < self.hi[rows]))
        if first is not None:
            at = at[first[buf[marks[at] + 1]]]
        found = []
        for k in range(1, most + 1):
            if k > 1:
                at = at[at + k - 1 < len(marks)]
                at = at[comma[at + k - 1] & (rows[at + k - 1] == rows[at])]
            if not at.size:
                break
            after = np.minimum(at + k, len(marks) - 1)
            end = np.where((at + k < len(marks)) & (rows[after] == rows[at]), marks[after], self.hi[rows[at]])
            found.append((at, np.full(len(at), k), marks[at] + 1, _rtrim(buf, marks[at] + 1, end)))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


class Tails:
    """Texts (strings or UTF-8 bytes, with their leading blank) that bind to the comma before them, ready for whole batches."""

    def __init__(self, tails):
        raw = sorted({t.encode() if isinstance(t, str) else t for t in tails if t})
        self.texts = pa.array([t.decode() for t in raw], pa.string())
        self.most = 1 + max((t.count(b",") for t in raw), default=0)
        self.longest = max(map(len, raw), default=0)
        self.first = np.zeros(256, bool)
        self.first[[t[0] for t in raw]] = True

    def bound(self, marked: Marked) -> np.ndarray:
        """Which marks are commas of a name: the longest tail wins, and its own commas bind no further ones."""
        drop = np.zeros(len(marked.marks), bool)
        if not len(self.texts) or not drop.size:
            return drop
        at, k, lo, hi = marked.spans(self.most, self.first)
        short = (hi > lo) & (hi - lo <= self.longest)
        at, k, lo, hi = at[short], k[short], lo[short], hi[short]
        hit = pc.is_in(_gather(marked.buf, lo, hi), self.texts).to_numpy(zero_copy_only=False)
        reach = np.zeros(len(drop), np.int64)
        np.maximum.at(reach, at[hit], k[hit])
        drop = reach > 0
        free = 0
        for i in np.flatnonzero(reach > 1).tolist():
            if i >= free:
                free = i + int(reach[i])
                drop[i:free] = True
        return drop


def split_buffer(texts: pa.Array, separators: str = ";|,", tails: Tails | frozenset[bytes] = frozenset()) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(ordinal of the parent row, position from 1, value) of every value in `texts`; `tails` bind to the comma before them."""
    m = Marked(texts, separators)
    buf, n, lo, hi, odd, as_json, row_of, marks = m.buf, m.n, m.lo, m.hi, m.odd, m.as_json, m.row_of, m.marks
    if tails:
        marks = marks[~(tails if isinstance(tails, Tails) else Tails(tails)).bound(m)]

    counts = np.bincount(row_of[marks], minlength=n)[:n] + 1 if n else np.zeros(0, np.int64)
    starts = np.sort(np.concatenate([lo, marks + 1]), kind="stable")
    ends = np.sort(np.concatenate([hi, marks]), kind="stable")
    parents = np.repeat(np.arange(n), counts)
    starts, ends = _trim(buf, starts, ends)
    keep = starts < ends
    starts, ends, parents = starts[keep], ends[keep], parents[keep]

    wide = np.flatnonzero((ends - starts >= 2) & ~odd[parents])
    quoted = np.zeros(len(starts), bool)
    quoted[wide] = (buf[starts[wide]] == QUOTE) & (buf[ends[wide] - 1] == QUOTE)
    values = pc.utf8_trim_whitespace(_unquote(_gather(buf, starts + quoted, ends - quoted), quoted, as_json[parents]))
    some = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    values, parents = values.filter(pa.array(some)), parents[some]
    first = np.searchsorted(parents, parents, side="left")
    return parents, (np.arange(len(parents)) - first + 1).astype(np.int32), values


def _escaped(buf: np.ndarray, offsets: np.ndarray, as_json: np.ndarray) -> np.ndarray:
    """Bytes of JSON rows that a backslash before them escapes: the run of backslashes before has odd length."""
    slash = buf == BACKSLASH
    index = np.arange(len(buf))
    last_other = np.maximum.accumulate(np.where(slash, -1, index))
    run = index - last_other
    out = np.zeros(len(buf), bool)
    out[1:] = slash[:-1] & (run[:-1] % 2 == 1)
    return out & np.repeat(as_json, np.diff(offsets))


def _single_letters(buf, marks, row_of, lo, hi) -> np.ndarray:
    """Slashes with one sign only on a side."""
    rows = row_of[marks]
    same_before = np.concatenate([[False], rows[1:] == rows[:-1]])
    left = np.where(same_before, np.concatenate([[0], marks[:-1]]) + 1, lo[rows])
    right = np.where(np.concatenate([same_before[1:], [False]]), np.concatenate([marks[1:], [0]]), hi[rows])
    a, b = _trim(buf, left, marks)
    c, d = _trim(buf, marks + 1, right)
    return (buf[marks] == SLASH) & ((b - a == 1) | (d - c == 1))


def _unquote(bare: pa.Array, quoted: np.ndarray, from_json: np.ndarray) -> pa.Array:
    """Values without the quoting of the list: doubled quotes become one, unless single ones stand among them, which
    makes the outer quotes a part of the value; backslash escapes of JSON are decoded, value by value, where there are any."""
    inner = pc.match_substring(bare, '"').to_numpy(zero_copy_only=False) & quoted & ~from_json
    if inner.any():
        some = bare.filter(pa.array(inner))
        single = pc.replace_substring(some, '""', "\0")
        plain = pc.replace_substring(single, "\0", '"')
        kept = pc.binary_join_element_wise('"', some, '"', "")
        bare = pc.replace_with_mask(bare, pa.array(inner), pc.if_else(pc.match_substring(single, '"'), kept, plain))
    escaped = pc.match_substring(bare, "\\").to_numpy(zero_copy_only=False) & quoted & from_json
    if escaped.any():
        decoded = [_json_text(t) for t in bare.filter(pa.array(escaped)).to_pylist()]
        bare = pc.replace_with_mask(bare, pa.array(escaped), pa.array(decoded, pa.string()))
    return bare


def _json_text(text: str) -> str:
    try:
        return str(json.loads(f'"{text}"'))
    except ValueError:
        return text


def quoted_tails(df: DataFrame, field: str) -> DataFrame:
    """`tail`: the distinct texts after the first comma of the quoted values of `field`."""
    values = F.regexp_extract_all(F.col(field), F.lit('"((?:[^"]|"")*)"'), F.lit(1))
    return (
        df.where(F.col(field).contains(",") & F.col(field).contains('"'))
        .select(F.explode(values).alias("value"))
        .where(F.col("value").contains(","))
        .select(F.regexp_replace(F.expr("substring(value, locate(',', value) + 1)"), r"[ \t\n\x0B\f\r]+$", "").alias("tail"))
        .where("trim(tail) != '' and trim(tail) not rlike '^[\\\\],;|]'")
        .distinct()
    )


def split_packed(df: DataFrame, field: str, keep: list[str], separators: str = ";|,", learn: bool = True, flat: bool = True, tail_bound: int = TAIL_BOUND) -> DataFrame:
    """`keep` and the values of `field`: `item_pos int, item_value string` (flat), or an array `items`, one row per row.

    `keep` and `field` name columns of `df`; other columns are dropped, so clashing names do no harm as long as `keep`
    has none of `item_pos, item_value, items`. With `flat=False` rows without a value get an empty array."""
    clash = {"item_pos", "item_value", "items", "_tails"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with those of the result")
    kept = [F.col(k) for k in dict.fromkeys(keep)]
    src = df.select(*kept, F.col(field).cast("string").alias("_packed"))
    known: Tails | frozenset = frozenset()
    by_row = False
    if learn:
        tails = cut(quoted_tails(src, "_packed"), "tails")
        count, size, commas = tails.agg(F.count("*"), F.sum(F.octet_length("tail")), F.max(F.size(F.split("tail", ",")))).first()
        by_row = count > tail_bound or (size or 0) > TAIL_BYTES
        if by_row:
            src = _with_row_tails(src, tails, separators, commas)
        elif count:
            known = Tails([r.tail for r in tails.collect()])
    schema = T.StructType([f for f in src.schema if f.name not in ("_packed", "_tails")])
    if flat:
        out_schema = T.StructType([*schema.fields, T.StructField("item_pos", T.IntegerType(), False), T.StructField("item_value", T.StringType(), False)])
    else:
        out_schema = T.StructType([*schema.fields, T.StructField("items", T.ArrayType(T.StringType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a row's own tails are those of the lexicon among all its spans, so one lookup serves the whole batch
            own = Tails(pc.unique(batch.column("_tails").flatten()).to_pylist()) if by_row else known
            parents, pos, values = split_buffer(batch.column("_packed"), separators, own)
            rest = batch.select([f.name for f in schema])
            if flat:
                rest = rest.take(pa.array(parents))
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(pos), values], names=[*rest.schema.names, "item_pos", "item_value"])
            else:
                offsets = np.searchsorted(parents, np.arange(batch.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.ListArray.from_arrays(pa.array(offsets), values)], names=[*rest.schema.names, "items"])

    return src.mapInArrow(run, out_schema)


def _with_row_tails(src: DataFrame, tails: DataFrame, separators: str, most: int) -> DataFrame:
    """`src` with `_tails`, the tails of the lexicon among the spans of the row's text.

    The spans are those that the kernel looks up where the lexicon is sent to it, so both ways bind the same commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = Marked(batch.column(0), separators)
            at, _, lo, hi = marked.spans(most)
            rows = marked.row_of[marked.marks[at]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), _gather(marked.buf, lo, hi)], names=["_packed", "tail"])

    texts = src.where(F.col("_packed").contains(",")).select("_packed").distinct()
    spans = texts.mapInArrow(run, "_packed string, tail string").where("tail != ''").distinct()
    own = spans.hint("merge").join(tails, "tail", "left_semi").groupBy("_packed").agg(F.collect_set("tail").alias("_tails"))
    return src.join(own.hint("merge"), "_packed", "left")


def values_of(df: DataFrame, field: str, key: str, field_name: str, separators: str = ";|,") -> DataFrame:
    """`field_name, record_key, item_pos, item_value`: the distinct values of a packed field by record.

    Rows with the same key and value give their values once; rows without a key belong to no record and give none."""
    src = df.where(F.col(key).isNotNull() & F.col(field).isNotNull()).select(F.col(key).cast("string").alias("record_key"), F.col(field).alias("_field"))
    found = split_packed(src, "_field", ["record_key"], separators)
    return found.select(F.lit(field_name).alias("field_name"), "record_key", "item_pos", "item_value").distinct()


def phase_separators() -> str:
    """Delimiters of a field whose values are joined by slashes as well."""
    return ";|,/"


