"""Suffix-array dedup: bytes that stand in a long match with an earlier document are removed, the first copy stays.

What is asked: remove every byte covered by a string of ``length`` bytes that also
starts in a document with a smaller id.  In suffix order, equal prefixes stand
together; the longest previous factor of a position is the larger of its common
prefixes with the nearest earlier-document neighbours in that order (previous and
next smaller), so a position begins such a string if and only if its longest
previous factor, cut off at ``length``, is ``length``.

A suffix array of the whole corpus would move every suffix.  It is built only where
it can matter:

1. Anchors.  Every window of ``length`` bytes has the least hash among its K-byte
   grams; equal windows have equal least grams at equal offsets.  Runs of windows
   with the same least gram (about 7 % as many as bytes) are sent as (gram hash,
   run hash) packed in numpy arrays to the gram's bucket.  Of one gram a batch
   sends one run only, so a passage that a third of all documents share is one
   entry for each batch.
2. Equal runs are one entry, that of the least document: in suffix order the
   suffixes of equal runs stand together, and the previous smaller document of the
   others is the least one.  Runs of a gram with one run are unique and go no
   further.  What is left are suspects: different runs around the same gram.
3. The bytes of suspects make the suffixes of the sparse suffix array.  They meet by
   gram and are sorted; common prefixes of neighbours and the nearest smaller
   documents on both sides (previous and next smaller values) give the longest
   previous factor of each.  Suspects of a gram that has more than HOT are dealt out
   by longer grams within their windows instead, and of equal pieces a batch sends
   the least document's only: the same sort, in smaller parts.
4. The removed windows of a document are united, its bytes cut.

Runs are told apart by 48 bits of the gram's hash and 48 bits of the run's.  What is
known of a run holds for its document id and its bytes, not for a row: rows with an
equal doc_id are one document for the purpose of 'smaller', never remove from each
other, and lose only bytes that a smaller id has.

A null text is empty.  Texts shorter than ``length`` lose nothing, and neither do rows
without a doc_id, from which nothing is removed elsewhere either.  Other columns of
docs are read only if they are to be carried; a carried column with the name of a
result (n_bytes, n_removed, n_spans, kept) is refused.  Matches are on the encoded
bytes, and what remains may end within a code point (``kept`` is binary;
``kept_text`` drops incomplete code points).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import let_go, release, shuffle_partitions, stash
from gleaner.session import ship

LENGTH = 50
#: Bytes of the grams that anchor runs.
GRAM = 24
#: Suspects of one gram from which on they are dealt out by grams of LONGER bytes less than a window, or by whole windows
#: from HOTTER times as many on.
HOT, HOTTER, LONGER = 2_000, 50, 6
#: Bytes of text that are packed at a time; bytes hashed at a time.
BATCH_BYTES, SLICE = 8 << 20, 1 << 17

_TABLE = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out[i + 1] = out[i] * _BASE
    return out


_POW = _powers(1 << 12)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash of the k bytes at each position, by doubling."""
    h = {1: _TABLE[data]}
    n = 1
    while 2 * n <= k:
        h[2 * n] = h[n][:-n] * _POW[n] + h[n][n:]
        n *= 2
    out, done = h[n], n
    while done < k:
        m = 1 << ((k - done).bit_length() - 1)
        more = h[m][done:]
        size = min(len(out), len(more))
        out = out[:size] * _POW[m] + more[:size]
        done += m
    return out


def runs_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, gram hash) of the runs of a text; windows = len - length + 1, covered without gaps.

    A run holds successive windows with the same least gram hash, ``length`` - ``gram`` + 1 windows at most.
    """
    n, width = len(data) - length + 1, length - gram + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return e, e, e.astype(np.uint64)
    starts, values = [], []
    for at in range(0, n, SLICE):
        part = data[at : min(at + SLICE, n) + length - 1]
        m = _mix(rolling(part, gram))
        k = 1
        while 2 * k <= width:
            m = np.minimum(m[:-k], m[k:])
            k *= 2
        if width > k:
            m = np.minimum(m[: len(m) - (width - k)], m[width - k :])
        change = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        starts.append(change + at)
        values.append(m[change])
    first, value = np.concatenate(starts), np.concatenate(values)
    size = np.diff(np.r_[first, n])
    # a gram that repeats within a text can hold for longer than a window: cut to equal steps from the run's start
    wide = size > width
    if wide.any():
        parts = np.where(wide, -(-size // width), 1)
        index = np.repeat(np.arange(len(first)), parts)
        step = np.arange(len(index)) - np.repeat(np.cumsum(parts) - parts, parts)
        first, value = first[index] + step * width, value[index]
        size = np.diff(np.r_[first, n])
    return first, size, value


def run_hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A 64-bit hash of each run's bytes, from differences of prefix hashes."""
    out = np.empty(len(first), np.uint64)
    stop = first + size + length - 1
    at = 0
    while at < len(first):
        lo = int(first[at])
        end = int(np.searchsorted(first, lo + 2048, side="left"))
        end = max(end, at + 1)
        part = data[lo : int(stop[end - 1])]
        # prefix sums of byte values times falling powers: hash(a, b) = sum of T[x_i] * B**(b - i)
        n = len(part)
        scaled = np.cumsum(_TABLE[part] * _POW[n - 1 :: -1][:n] if n > 1 else _TABLE[part])
        p = np.r_[np.uint64(0), scaled]
        a, b = first[at:end] - lo, stop[at:end] - lo
        # brought to a common scale by the inverse power
        out[at:end] = (p[b] - p[a]) * _INVERSE[n - b]
        at = end
    return _mix(out ^ (size.astype(np.uint64) << np.uint64(56)))


def _inverses(n: int) -> np.ndarray:
    inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out[i + 1] = out[i] * inv
    return out


_INVERSE = _inverses(1 << 12)


def anchored(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        first, size, value = runs_of(data, length, gram)
        return first, size, value, run_hashes(data, first, size, length)


ENTRY = np.dtype([("gram", "<u8"), ("run", "<u8"), ("doc", "<i8")])


def pack_batch(docs: list[tuple[int, bytes]], buckets: int, length: int, gram: int):
    """(entries with a flag by bucket, copies, suspects): one entry for each gram of the batch; the rest is known already."""
    parts = []
    for doc, text in docs:
        _, _, value, run = anchored(np.frombuffer(text, np.uint8), length, gram)
        e = np.empty(len(value), ENTRY)
        e["gram"], e["run"], e["doc"] = value, run, doc
        parts.append(e)
    e = np.concatenate(parts) if parts else np.empty(0, ENTRY)
    e = e[np.lexsort((e["doc"], e["run"], e["gram"]))]
    if not len(e):
        return e, np.zeros(0, bool), e, e
    new_gram = np.r_[True, e["gram"][1:] != e["gram"][:-1]]
    new_run = new_gram | np.r_[True, e["run"][1:] != e["run"][:-1]]
    new_doc = new_run | np.r_[True, e["doc"][1:] != e["doc"][:-1]]
    run_of = np.cumsum(new_run) - 1
    least = e["doc"][new_run][run_of]
    copies = e[new_doc & (e["doc"] > least)]
    heads = e[new_run]
    head_gram = np.cumsum(new_gram)[new_run] - 1
    several = np.bincount(head_gram)[head_gram] > 1
    sent = new_gram[new_run]
    return heads[sent], several[sent], copies, heads[~sent]


def nearest_smaller(docs: np.ndarray, link: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """The common prefix of each suffix with the nearest one of a smaller document on one side; 0 where that is below least.

    link: each suffix's neighbour on that side; common: their common prefix (0 at the end).  Whatever lies between a
    suffix and its link is of no smaller document, so links are followed together, each over its neighbour's.
    """
    link, common = link.copy(), common.copy()
    least = max(1, least)
    live = np.flatnonzero(common >= least)
    live = live[docs[link[live]] >= docs[live]]
    while len(live):
        j = link[live]
        common[live] = np.minimum(common[live], common[j])
        link[live] = link[j]
        live = live[common[live] >= least]
        live = live[docs[link[live]] >= docs[live]]
    return np.where(common >= least, common, 0)


def lpf(text: np.ndarray, docs: np.ndarray, least: int = 0) -> np.ndarray:
    """The longest previous factor of each suffix (row of bytes), cut off at the row's length; previous: of a smaller document.

    From the suffix array of the rows, the common prefixes of neighbours, and the previous and next smaller documents.
    Factors below ``least`` are not followed to their end and count as 0.
    """
    n, length = text.shape
    if not n:
        return np.zeros(0, np.int64)
    keys = text if (text == 0).any() else np.ascontiguousarray(text).view(f"S{length}").reshape(-1)
    order = np.lexsort((docs, keys) if keys.ndim == 1 else (docs, *text.T[::-1]))
    t, d = text[order], docs[order]
    same = t[1:] == t[:-1]
    common = np.r_[0, np.where(same.all(1), length, same.argmin(1) if n > 1 else 0)].astype(np.int64)
    place = np.arange(n)
    out = np.empty(n, np.int64)
    out[order] = np.maximum(nearest_smaller(d, place - 1, common, least), nearest_smaller(d, place + 1, np.r_[common[1:], 0], least))
    return out


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, marks) for each document with removals; marks: structs (pair, mask), pair a hash of (gram, run).

    Bit i of a mask says that the run's window i is removed; -1: all of them.
    """
    if length - gram >= 63:
        raise ValueError("a run's windows must fit a mask")
    spark = docs.sparkSession
    ship(spark)
    buckets = shuffle_partitions(spark)
    kinds = "bucket int, kind int, data binary"

    def anchors(batches):
        let_go()
        held: list[tuple[int, bytes]] = []
        size, salt = 0, 0

        def put_out():
            nonlocal salt
            sent, several, copies, suspects = pack_batch(held, buckets, length, gram)
            rows: list[tuple[int, int, bytes]] = []
            at = (sent["gram"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            bounds = np.searchsorted(at[order], np.arange(buckets + 1))
            for k in range(buckets):
                i = order[bounds[k] : bounds[k + 1]]
                if len(i):
                    e = sent[i]
                    base = e["doc"].min()
                    delta = e["doc"] - base
                    width = "<u4" if delta.max() < 1 << 32 else "<u8"
                    # hashes shortened to 48 bits and the bucket; ids to their distance from the least
                    head = np.array([len(e), base, int(width[-1])], "<i8").tobytes()
                    rows.append((k, 0, head + _six(e["gram"]) + _six(e["run"]) + delta.astype(width).tobytes() + np.packbits(several[i]).tobytes()))
            for kind, e in ((1, copies), (2, suspects)):
                for part in np.array_split(e, -(-len(e) // 20_000)) if len(e) else []:
                    rows.append((int(part["gram"][0] ^ part["run"][-1]) % buckets, kind, part.tobytes()))
                    salt += 1
            for i in range(0, len(rows), 64):
                b, k, d = zip(*rows[i : i + 64])
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(d, pa.binary())], ["bucket", "kind", "data"])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                x = (t.as_py() or "").encode()
                if len(x) >= length:
                    held.append((k, x))
                    size += len(x)
                if size >= BATCH_BYTES:
                    yield from put_out()
                    held, size = [], 0
        if held:
            yield from put_out()

    def meet(_, table):
        whole: list[np.ndarray] = []
        flags: list[np.ndarray] = []
        out = []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data")):
            raw = data.as_buffer()
            if kind:
                e = np.frombuffer(raw, ENTRY)
                out.append((_short(e["gram"]), _short(e["run"]), e["doc"], np.full(len(e), kind == 1)))
                continue
            n, base, width = np.frombuffer(raw, "<i8", 3)
            at = 24
            e = np.empty(n, ENTRY)
            e["gram"], e["run"] = _wide(raw, at, n), _wide(raw, at + 6 * n, n)
            e["doc"] = np.frombuffer(raw, f"<u{width}", n, at + 12 * n).astype(np.int64) + base
            whole.append(e)
            flags.append(np.unpackbits(np.frombuffer(raw, np.uint8, -1, at + (12 + width) * n), count=n).astype(bool))
        if whole:
            e, several = np.concatenate(whole), np.concatenate(flags)
            order = np.lexsort((e["doc"], e["run"], e["gram"]))
            e, several = e[order], several[order]
            new_gram = np.r_[True, e["gram"][1:] != e["gram"][:-1]]
            new_run = new_gram | np.r_[True, e["run"][1:] != e["run"][:-1]]
            group = np.cumsum(new_gram) - 1
            some = np.bincount(group, weights=several) > 0
            many = np.bincount(group, weights=new_run) > 1
            least = e["doc"][new_run][np.cumsum(new_run) - 1]
            copy = e["doc"] > least
            suspect = ~copy & (some | many)[group]
            keep = copy | suspect
            out.append((e["gram"][keep], e["run"][keep], e["doc"][keep], copy[keep]))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64), np.zeros(0, bool)]
        copy = cols[3].astype(bool)
        # of a copy the pair of hashes is all that is asked for later; a suspect is met again by its gram
        return pa.table({"pair": _pair(cols[0], cols[1]).view(np.int64), "g": pa.array(cols[0].astype(np.int64), mask=copy), "doc": cols[2].astype(np.int64)})

    body = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).filter(F.col("_doc").isNotNull())
    found = stash(body.mapInArrow(anchors, kinds).groupBy("bucket").applyInArrow(meet, "pair long, g long, doc long"))
    release(spark)

    # of equal suspects the one of the least document is met by its bytes, the others are copies of it
    whole = F.lit(-1).cast("long").alias("mask")
    suspects = stash(found.filter("g is not null").withColumn("least", F.min("doc").over(Window.partitionBy("g", "pair"))))
    heads = suspects.filter("doc = least").select("g", "pair", "doc").distinct()
    hot = F.when(F.col("n") > HOT * HOTTER, length).when(F.col("n") > HOT, max(gram, length - LONGER)).alias("by")
    crowded = heads.groupBy("g").agg(F.count("*").alias("n")).select("g", hot).filter("by is not null")
    asked = heads.join(crowded, "g", "left").groupBy("doc").agg(F.collect_list(F.struct("pair", "by")).alias("asked"))
    asked = body.join(asked, F.col("_doc") == F.col("doc")).select("_doc", "_text", "asked")
    groups = 4 * buckets
    names, kinds = ["b", "doc", "pair", "first", "bytes", "mask"], (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())

    def cut_out(batches):
        """Suspects by bucket (b, doc, pair, first window, bytes), and marks of those settled here (doc, pair, mask)."""
        let_go()
        rows: list[tuple] = []
        pieces: dict[tuple[int, bytes], list[tuple[int, int, int, int]]] = {}

        def put_out():
            for (value, piece), places in pieces.items():
                places.sort()
                doc, pair, first, _ = places[0]
                rows.append((value % groups, doc, pair, first, piece, None))
                rows.extend((None, d, p, None, None, ((1 << n) - 1) << i) for d, p, i, n in places if d > doc)
            pieces.clear()
            for at in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 20_000]), kinds)], names)
            rows.clear()

        size = 0
        for b in batches:
            for doc, t, wanted in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                pairs, by = (c.to_numpy(zero_copy_only=False) for c in wanted.values.flatten())
                x = t.as_py().encode()
                if len(x) < length:  # another row has this id
                    continue
                first, n_windows, value, run = anchored(np.frombuffer(x, np.uint8), length, gram)
                own = _pair(_short(value), _short(run)).view(np.int64)
                order = np.argsort(pairs)
                place = np.minimum(np.searchsorted(pairs[order], own), len(pairs) - 1)
                at = np.flatnonzero(pairs[order][place] == own)
                at = at[np.unique(own[at], return_index=True)[1]]
                longer = by[order][place[at]]
                where = (_mix(_short(value[at])) % np.uint64(groups)).astype(np.int64)
                for i, k, g in zip(at.tolist(), where.tolist(), longer.tolist()):
                    a, n, pair = int(first[i]), int(n_windows[i]), int(own[i])
                    piece = x[a : a + n + length - 1]
                    size += len(piece)
                    if g is None or g != g:
                        rows.append((k, doc, pair, 0, piece, None))
                        continue
                    with np.errstate(over="ignore"):
                        parts = runs_of(np.frombuffer(piece, np.uint8), length, int(g))
                    for f, m, v in zip(*(c.tolist() for c in parts)):
                        pieces.setdefault((v, piece[f : f + m + length - 1]), []).append((doc, pair, f, m))
                if size >= BATCH_BYTES:
                    yield from put_out()
                    size = 0
        yield from put_out()

    rows = stash(asked.mapInArrow(cut_out, "b int, doc long, pair long, first int, bytes binary, mask long"))
    del asked
    release(spark)

    def sort_suffixes(_, table):
        runs = table.column("bytes").combine_chunks()
        ends = np.frombuffer(runs.buffers()[1], np.int32, len(runs) + 1, 4 * runs.offset).astype(np.int64)
        data = np.frombuffer(runs.buffers()[2], np.uint8)
        docs_, pairs, firsts = (table.column(c).to_numpy() for c in ("doc", "pair", "first"))
        windows = np.diff(ends) - (length - 1)
        own = np.repeat(np.arange(len(windows)), windows)
        at = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
        # suffixes of all grams of the bucket are sorted at once: equal windows have equal grams
        suffixes = np.lib.stride_tricks.sliding_window_view(data, length)[ends[:-1][own] + at]
        hit = lpf(suffixes, docs_[own], length) >= length
        mask = np.zeros(len(windows), np.int64)
        np.bitwise_or.at(mask, own[hit], np.int64(1) << (at + firsts[own])[hit])
        some = np.flatnonzero(mask)
        return pa.table({"doc": pa.array(docs_[some], pa.int64()), "pair": pa.array(pairs[some], pa.int64()), "mask": pa.array(mask[some], pa.int64())})

    met = rows.filter("b is not null").drop("mask").groupBy("b").applyInArrow(sort_suffixes, "doc long, pair long, mask long")
    here = rows.filter("b is null").select("doc", "pair", "mask")
    copies = found.filter("g is null").select("doc", "pair", whole).unionAll(suspects.filter("doc > least").select("doc", "pair", whole))
    return copies.unionAll(met).unionAll(here).groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("pair", "mask")).alias("marks"))


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _wide(raw, at: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, at).reshape(n, 6)
    return out.view("<u8").reshape(-1)


def _short(x: np.ndarray) -> np.ndarray:
    return x & np.uint64((1 << 48) - 1)


def _pair(gram: np.ndarray, run: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(gram * _BASE + run)


def removed_windows(text: bytes, pairs: np.ndarray, masks: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Whether each byte is removed."""
    n = len(text)
    cover = np.zeros(n + 1, np.int64)
    known, back = np.unique(pairs, return_inverse=True)
    bits = np.zeros(len(known), np.int64)
    np.bitwise_or.at(bits, back, masks)
    first, size, value, run = anchored(np.frombuffer(text, np.uint8), length, gram)
    own = _pair(_short(value), _short(run)).view(np.int64)
    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
    hit = known[place] == own
    first, size, mask = first[hit], size[hit], bits[place[hit]]
    every = mask == -1
    np.add.at(cover, first[every], 1)
    np.add.at(cover, first[every] + size[every] + length - 1, -1)
    first, size, mask = first[~every], size[~every], mask[~every]
    for i in range(int(size.max(initial=0))):
        at = first[(size > i) & ((mask >> i) & 1 == 1)] + i
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
    return np.cumsum(cover[:n]) > 0


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, columns to carry, n_bytes, n_removed, n_spans, kept binary) of every row."""
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    clash = {"n_bytes", "n_removed", "n_spans", "kept"}.intersection([key, *carry])
    if clash:
        raise ValueError(f"columns to carry have the names of results: {sorted(clash)}")
    marks = removed_spans(docs, length, gram, key, text)
    columns = list(dict.fromkeys([key, *carry]))
    fields = {f.name: f for f in docs.schema.fields}
    schema = StructType([*[fields[c] for c in columns], StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept", BinaryType())])

    def run(batches):
        let_go()
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for t, m in zip(b.column(1), b.column(2)):
                x = (t.as_py() or "").encode()
                removed, spans, kept = 0, 0, x
                if m.is_valid and len(x) >= length:
                    gone = removed_windows(x, *(c.to_numpy() for c in m.values.flatten()), length, gram)
                    removed = int(gone.sum())
                    spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                    kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
                for c, v in zip(rows, (len(x), removed, spans, kept)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*b.column(0).flatten(), *[pa.array(c, pa.int64()) for c in rows[:3]], pa.array(rows[3], pa.binary())], [*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    ship(docs.sparkSession)
    # the carried columns are one, so none can clash with those used here
    left = docs.select(F.col(f"`{key}`").alias("_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_own"), F.col(f"`{text}`").alias("_text"))
    joined = left.join(marks, F.col("_key") == F.col("_doc"), "left").select("_own", "_text", "marks")
    return joined.mapInArrow(run, schema)


def kept_text(column: str):
    """The bytes as text; bytes of code points that were cut are left out."""
    sound = F.expr(f"try_validate_utf8(cast({column} as string))")
    return F.coalesce(sound, F.expr(f"replace(make_valid_utf8(cast({column} as string)), '\\uFFFD', '')"))
