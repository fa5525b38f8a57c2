"""Removal of passages that an earlier document has, byte for byte.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a smaller id. All strings of that
length are judged, and none is compared across documents:

1. *Anchors.* Each string of ``length`` bytes (a window) has one anchor: its k-gram with the least hash, the leftmost of
   equals. Equal windows have equal anchors. Neighbouring windows with the same anchor are a run. Every task sends, per
   anchor bucket, the hash of the anchor and of the run; of equal runs only those of the least document leave the task
   (larger documents are settled there), so a hot passage is one row per task however often it occurs.
2. *Runs.* In a bucket, a run that equals a run of a smaller document is settled as a whole. Only anchors that occur with
   different runs are left: the ends of shared passages, and chance meetings.
3. *Suffixes.* The texts of those runs are fetched, and all their windows are sorted as suffixes by deep-shallow sorting:
   multikey quicksort with 8-byte symbols to a shallow depth, then a blind trie for each group that still agrees. Windows
   that agree to the end are equal; those of larger documents than the group's least go.
4. The spans are merged per document and cut out.

Null ids count as larger than all others, null texts as empty. Documents shorter than ``length`` keep everything. Rows that
repeat an id are judged as rows of one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .membership import told_apart
from .packed import bucket_count, joined, pack, unpack
from .state import cut, fresh, passing
from .text import RangeHash, slices

LENGTH, GRAM = 50, 20
SHALLOW = 16
FLUSH_ROWS = 1_000_000
FEW_ROWS = 500  # texts held as Python objects at a time
LAST_ID = (1 << 63) - 1
SLICE = 1 << 19


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by block-wise running minima."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window within the row, number of windows, anchor hash, run hash) of every run of a slice."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    hashed = RangeHash(data)
    at = np.arange(len(data) - gram + 1)
    grams = hashed(at, at + gram)
    least = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(anchor))
    row = np.searchsorted(offsets, start, side="right") - 1
    valid = start + length <= offsets[row + 1]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    ended = valid.copy()
    ended[:-1] &= ~valid[1:] | new[1:]
    last = np.flatnonzero(ended)
    return row[first], first - offsets[row[first]], last - first + 1, grams[anchor[first]], hashed(first, last + length)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new value of the (sorted) columns begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


class _Outbox:
    """Collects runs of a task and writes them as packed rows by anchor bucket, and settled spans by document bucket."""

    def __init__(self, buckets: int, length: int):
        self.buckets, self.length, self.parts, self.rows = buckets, length, [], 0

    def add(self, doc, mark, start, count, anchor, run):
        self.parts.append((doc, mark.astype(np.uint32), start.astype(np.uint32), count.astype(np.uint8), anchor, run))
        self.rows += len(doc)

    def flush(self):
        if not self.rows:
            return
        doc, mark, start, count, anchor, run = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.rows = [], 0
        order = np.lexsort((doc, run, anchor))
        doc, mark, start, count, anchor, run = (c[order] for c in (doc, mark, start, count, anchor, run))
        least = _least(_starts(anchor, run), doc)
        settled = doc > least
        yield from spans_out(doc[settled], mark[settled], start[settled],
                             start[settled].astype(np.int64) + count[settled] - 1 + self.length, self.buckets)
        doc, mark, start, count, anchor, run = (c[~settled] for c in (doc, mark, start, count, anchor, run))
        bucket = (anchor % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(at):
                key = doc[at].astype(np.int64)
                names, index = np.unique(np.stack([key, mark[at].astype(np.int64)]), axis=1, return_inverse=True)
                yield 0, int(bucket[at[0]]), pack(np.diff(anchor[at], prepend=np.uint64(0)), run[at], index.reshape(-1).astype(np.uint32),
                                                  start[at].astype(np.uint32), count[at].astype(np.uint8), _diff(names[0]), names[1].astype(np.uint32))


def _diff(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.diff(values.astype(np.int64), prepend=np.int64(0))


def _least(new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The least document of each group, for every row; groups begin where ``new`` is set."""
    if not len(doc):
        return doc
    at = np.flatnonzero(new)
    return np.repeat(np.minimum.reduceat(doc, at), np.diff(np.append(at, len(doc))))


def document_bucket(doc, mark, buckets: int) -> np.ndarray:
    """Documents by id and text, so that rows without an id spread too."""
    return (np.asarray(doc, np.int64) % buckets + np.asarray(mark, np.int64)) % buckets


def spans_out(doc, mark, start, end, buckets: int):
    """Rows (1, document bucket, payload) of spans; neighbouring and overlapping spans of a document are merged."""
    doc, mark, start, end = merged(doc, mark, start, end)
    bucket = document_bucket(doc, mark, buckets)
    order = np.argsort(bucket, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(at):
            yield 1, int(bucket[at[0]]), pack(_diff(doc[at]), mark[at].astype(np.uint32), start[at].astype(np.uint32), end[at].astype(np.uint32))


def merged(doc, mark, start, end):
    order = np.lexsort((end, start, mark, doc))
    doc, mark, start, end = (np.asarray(c)[order].astype(np.int64) for c in (doc, mark, start, end))
    if not len(doc):
        return doc, mark, start, end
    group = np.cumsum(_starts(doc, mark))
    # a running maximum of ends within each document: shift each document beyond all ends of the one before
    shift = group * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    new = _starts(doc, mark)
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], mark[at], start[at], reach[np.append(at[1:], len(doc)) - 1]


_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _batch(rows, schema=_ROW):
    rows = list(rows)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _send_runs(buckets: int, length: int, gram: int):
    def run(batches):
        out = _Outbox(buckets, length)
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for part in slices(batch.column(2), SLICE):
                row, start, count, anchor, hashed = runs(part.data, part.offsets, length, gram)
                out.add(ids[part.first:part.last][row], marks[part.first:part.last][row], start, count, anchor, hashed)
                if out.rows >= FLUSH_ROWS:
                    for item in out.flush():
                        yield _batch([item])
        for item in out.flush():
            yield _batch([item])
    return run


def _meet(buckets: int, length: int):
    """A bucket of runs: settle equal runs (kind 1), ask for the texts of anchors with different runs (kind 2).

    Spans that were settled before pass through.
    """
    def run(key, table):
        if key[0].as_py() == 1:
            return table
        payloads = table.column("payload").to_pylist()
        parts = [unpack(p) for p in payloads]
        anchor = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        hashed, start, count = (np.concatenate([p[i] for p in parts]) for i in (1, 3, 4))
        doc = np.concatenate([np.cumsum(p[5])[p[2]] for p in parts])
        mark = np.concatenate([p[6][p[2]] for p in parts])
        start, count = start.astype(np.int64), count.astype(np.int64)
        order = np.lexsort((doc, hashed, anchor))
        anchor, hashed, doc, mark, start, count = (c[order] for c in (anchor, hashed, doc, mark, start, count))
        new_anchor, new_run = _starts(anchor), _starts(anchor, hashed)
        settled = doc > _least(new_run, doc)
        out = list(spans_out(doc[settled], mark[settled], start[settled], start[settled] + count[settled] - 1 + length, buckets))
        group = np.cumsum(new_anchor) - 1
        several = np.bincount(group[new_run]) > 1
        least, most = np.minimum.reduceat(doc, np.flatnonzero(new_anchor)), np.maximum.reduceat(doc, np.flatnonzero(new_anchor))
        ask = ~settled & (several & (least < most))[group]
        asked = np.flatnonzero(ask)
        bucket = document_bucket(doc[asked], mark[asked], buckets)
        by = np.argsort(bucket, kind="stable")
        for at in np.split(asked[by], np.flatnonzero(np.diff(bucket[by])) + 1):
            if len(at):
                out.append((2, int(document_bucket(doc[at[:1]], mark[at[:1]], buckets)[0]), pack(_diff(doc[at]), mark[at].astype(np.uint32), start[at].astype(np.uint32),
                                                              count[at].astype(np.uint8), anchor[at])))
        return pa.Table.from_batches([_batch(out)])
    return run


_WISH = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("payload", pa.binary())])


def _wishes(table):
    """Requests of a document bucket, one row per document."""
    parts = [unpack(p) for p in table.column("payload").to_pylist()]
    doc = np.concatenate([np.cumsum(p[0]) for p in parts])
    mark, start, count, anchor = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
    order = np.lexsort((start, mark, doc))
    doc, mark, start, count, anchor = (c[order] for c in (doc, mark, start, count, anchor))
    at = np.flatnonzero(_starts(doc, mark))
    rows = [(int(doc[i]), int(mark[i]), pack(start[i:j], count[i:j], anchor[i:j])) for i, j in zip(at, np.append(at[1:], len(doc)))]
    return pa.Table.from_batches([_batch(rows, _WISH)])


def _fetch(buckets: int, length: int):
    """Texts of requested runs, packed by anchor bucket (kind 3)."""
    def run(batches):
        for batch in (whole.slice(at, FEW_ROWS) for whole in batches for at in range(0, whole.num_rows, FEW_ROWS)):
            got: dict[int, list] = {}
            for doc, mark, text, payload in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = (text or "").encode()
                start, count, anchor = unpack(payload)
                for a, c, b in zip(start.tolist(), count.tolist(), (anchor % np.uint64(buckets)).tolist()):
                    got.setdefault(b, []).append((doc, mark, a, c, text[a:a + c - 1 + length]))
            for b, rows in got.items():
                doc, mark, start, count, texts = zip(*rows)
                yield _batch([(3, b, pack(np.array(doc, np.int64), np.array(mark, np.uint32), np.array(start, np.uint32),
                                          np.array(count, np.uint8), np.frombuffer(b"".join(texts), np.uint8)))])
    return run


class BlindTrie:
    """Sorted groups of equal keys. Inner nodes know only the position of the byte in which their branches differ."""

    def __init__(self, length: int):
        self.length, self.root = length, None

    def add(self, key: bytes, item: int):
        if self.root is None:
            self.root = [self.length, key, [item]]
            return
        node = self.root
        while node[0] < self.length:  # blind descent: any branch will do where the byte is unknown
            branches = node[1]
            node = branches.get(key[node[0]]) or next(iter(branches.values()))
        other = node[1]
        if other == key:
            node[2].append(item)
            return
        differ = int.from_bytes(other, "big") ^ int.from_bytes(key, "big")
        depth = self.length - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while node[0] < depth:
            above, node = node, node[1][key[node[0]]]
        leaf = [self.length, key, [item]]
        if node[0] == depth:
            node[1][key[depth]] = leaf
            return
        branch = [depth, {other[depth]: node, key[depth]: leaf}]
        if above is None:
            self.root = branch
        else:
            above[1][key[above[0]]] = branch

    def leaves(self):
        """Groups of equal keys, in the order of the keys."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] >= self.length:
                yield node[2]
            else:
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))


def equal_windows(data: np.ndarray, at: np.ndarray, length: int, shallow: int = SHALLOW):
    """Groups (index arrays into ``at``) of equal windows, two members at least, by deep-shallow sorting."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order, new = np.arange(len(at)), np.zeros(len(at), bool)
    new[:1] = True
    for depth in range(0, shallow, 8):  # multikey quicksort, eight bytes a symbol; groups of one are done
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        group = np.repeat(np.arange(len(size)), size)
        open_rows = size[group] > 1
        order, group = order[open_rows], group[open_rows]
        symbol = np.zeros(len(order), np.uint64)
        for k in range(8):
            symbol = (symbol << np.uint64(8)) | padded[at[order] + depth + k]
        by = np.lexsort((symbol, group))
        order, group, symbol = order[by], group[by], symbol[by]
        new = _starts(group, symbol) if len(order) else np.zeros(0, bool)
    text = data.tobytes()
    begin = np.flatnonzero(new)
    for i, j in zip(begin, np.append(begin[1:], len(order))):
        if j - i == 2:
            a, b = order[i], order[i + 1]
            if text[at[a]:at[a] + length] == text[at[b]:at[b] + length]:
                yield order[i:j]
        elif j - i > 2:
            trie = BlindTrie(length)
            for x in order[i:j].tolist():
                trie.add(text[at[x]:at[x] + length], x)
            for leaf in trie.leaves():
                if len(leaf) > 1:
                    yield np.array(leaf)


def _sort(buckets: int, length: int):
    """A bucket of run texts: windows that a smaller document has, as spans (kind 1)."""
    def run(table):
        doc, mark, start, count, data = joined(table.column("payload").to_pylist())[:5]
        sizes = count.astype(np.int64) - 1 + length
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(doc)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count.astype(np.int64)) - count, count)
        at = base[owner] + inside
        gone = []
        for group in equal_windows(data, at, length):
            members = owner[group]
            later = doc[members] > doc[members].min()
            gone.extend(group[later].tolist())
        gone = np.array(gone, np.int64)
        rows = owner[gone]
        begin = start[rows].astype(np.int64) + inside[gone]
        return pa.Table.from_batches([_batch(spans_out(doc[rows], mark[rows], begin, begin + length, buckets))])
    return run


def _spans(table):
    """Spans of a document bucket, merged: one row per document."""
    parts = [unpack(p) for p in table.column("payload").to_pylist()]
    doc = np.concatenate([np.cumsum(p[0]) for p in parts])
    mark, start, end = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    doc, mark, start, end = merged(doc, mark, start, end)
    at = np.flatnonzero(_starts(doc, mark)) if len(doc) else np.zeros(0, int)
    rows = [(int(doc[i]), int(mark[i]), pack(start[i:j], end[i:j])) for i, j in zip(at, np.append(at[1:], len(doc)))]
    return pa.Table.from_batches([_batch(rows, _WISH)])


_KIND = "kind int, bucket int, payload binary"
_KEPT_NAMES = ("n_bytes", "n_removed", "n_spans", "sha256", "text")
_KEPT = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
_BY_ROW = "id long, mark long, payload binary"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(text).bitwiseAND(F.lit((1 << 32) - 1)).alias("mark"), text.alias("text"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, mark, payload): packed removed spans of every document that has any; ``mark`` is a hash of its text."""
    buckets = bucket_count(docs.sparkSession, 1)
    texts = _texts(docs, id_col, text_col)
    with passing() as stays:
        sent = texts.mapInArrow(_send_runs(buckets, length, gram), _KIND)
        met = cut(sent.groupBy("kind", "bucket").applyInArrow(_meet(buckets, length), _KIND), "runs")
        wishes = cut(met.where("kind = 2").groupBy("bucket").applyInArrow(_wishes, _BY_ROW), "wishes")
        asked, _ = told_apart(texts, [F.col("id"), F.col("mark")], wishes.select("id", "mark"))
        asked = asked.join(wishes, ["id", "mark"]).select("id", "mark", "text", "payload")
        found = asked.mapInArrow(_fetch(buckets, length), _KIND).groupBy("bucket").applyInArrow(_sort(buckets, length), _KIND)
        spans = met.where("kind = 1").union(found)
        return stays(cut(spans.groupBy("bucket").applyInArrow(_spans, _BY_ROW), "spans"))


def kept_bytes(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """What is left of a text without the spans."""
    at = np.concatenate([[0], end.astype(np.int64)]), np.concatenate([start.astype(np.int64), [len(text)]])
    return b"".join(text[a:b] for a, b in zip(*at))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
            as_col: str = "kept") -> DataFrame:
    """``docs`` with a struct column ``as_col`` (n_bytes, n_removed, n_spans, sha256, text): each text without repeated passages.

    Bytes are judged, so a cut may fall inside a character; what is left of such a character is left out of ``text`` (the
    hash is of the bytes).
    """
    found = repeats(docs, id_col, text_col, length, gram)

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, sha256 string, text string")
    def clean(texts: pa.Array, payloads: pa.Array) -> pa.Array:
        done = []
        for at in range(0, max(1, len(texts)), FEW_ROWS):
            rows = []
            for text, payload in zip(texts.slice(at, FEW_ROWS).to_pylist(), payloads.slice(at, FEW_ROWS).to_pylist()):
                body = (text or "").encode()
                start, end = unpack(payload) if payload is not None else (np.zeros(0, np.int64),) * 2
                left = kept_bytes(body, start, end)
                rows.append((len(body), len(body) - len(left), len(start), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
            columns = list(zip(*rows)) or [[]] * len(_KEPT)
            done.append(pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _KEPT)], names=list(_KEPT_NAMES)))
        return pa.concat_arrays(done)

    clean = clean.asNondeterministic()  # so that Spark does not run it again for every field that is used
    names = {c: fresh(docs, f"__{c}") for c in found.columns}
    spans = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    own_id = F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID))
    own_mark = F.xxhash64(text).bitwiseAND(F.lit((1 << 32) - 1))
    may, whole = told_apart(docs, [own_id, own_mark], found.select("id", "mark"))
    cut_up = may.join(spans, (own_id == spans[names["id"]]) & (own_mark == spans[names["mark"]]), "left")
    rows = cut_up.drop(names["id"], names["mark"]).union(whole.withColumn(names["payload"], F.lit(None).cast("binary")))
    return rows.withColumn(as_col, clean(F.col(text_col).cast("string"), F.col(names["payload"]))).drop(names["payload"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, their texts without repeated passages; those of which nothing but white space is left go."""
    kept = fresh(docs, "kept")
    rows = cleaned(docs, id_col, text_col, as_col=kept)
    left, removed = F.col(f"{kept}.text"), F.col(f"{kept}.n_removed")
    rows = rows.where((removed == 0) | (F.trim(F.regexp_replace(left, r"[\x09-\x0D]", " ")) != ""))
    return rows.withColumn(text_col, F.when(removed > 0, left).otherwise(F.col(text_col))).drop(kept)
