"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  The plan needs only how
many pieces have each length: at most ``capacity`` counts, whatever the corpus
size.  Best fit decreasing runs over these counts, where all bins with the same
free room are one entry, so the driver's work depends on the number of lengths.
The plan is a table of runs (length, first rank, how many, first sequence,
offset): pieces of a length, numbered from 0, take the slots of that length in
order.  Ranks are dealt out in parallel: each task counts its pieces by length, a
prefix sum over (salt, length) gives where a salt's ranks begin.

Null texts are empty texts; an empty document is its end token.  Repeated rows and
equal doc_ids are packed row by row.  Other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import re
import struct
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import cut, held, shuffle_partitions
from gleaner.llm.lm_scoring import small_enough
from gleaner.session import ship

CAPACITY = 2048
END = 0
#: Bytes of text whose words are looked up together; characters of the longest word that is kept.
BATCH_BYTES, LONGEST_KEPT = 16 << 20, 64


#: Characters that one case of the byte-level pattern holds in every version of Unicode: the line feed, printed ASCII, Latin letters and signs.
COMMON = "\n" + "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x180)]))


def _common_pattern() -> re.Pattern:
    """The byte-level pattern over COMMON characters and the space."""
    letters, numbers = ("".join(c for c in COMMON if unicodedata.category(c)[0] == x) for x in "LN")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^ \n{letters}{numbers}]+|[ \n]+(?![^ \n])|[ \n]+")


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies spell a byte: printed Latin-1 characters stand for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in plain]
    return {x: chr(x) for x in plain} | {x: chr(256 + i) for i, x in enumerate(rest)}


class Tokens:
    """A tokenizers file's ids as little-endian 32-bit bytes, by words (a space and what follows it) that are kept.

    The vocabulary's pattern never matches across the start of white space, so a
    text's ids are those of its words; ``max_cached`` bounds the kept
    ones, in two generations: what was used lately stays.  A new word of COMMON
    characters goes to the file's model by its matches of the byte-level
    pattern, and these are kept: "word," is put together of " word" and ",".
    Any other word goes to the whole tokenizer.
    """

    def __init__(self, path: str, max_cached: int = 1_000_000):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        parts = json.loads(self.tokenizer.to_str())
        pre = parts["pre_tokenizer"] or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"] and not parts["normalizer"]
        self.is_common = re.compile(f"[{re.escape(COMMON)}]+").fullmatch if byte_level else lambda word: None
        self.matches = _common_pattern().findall
        self.names = _byte_names()
        self.max_cached = max_cached
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # matches with no space before

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _segments(self, segments: list[str]) -> dict[str, bytes]:
        """Many segments in one call: a line feed between two of them is a token of its own, where the ids are cut apart again."""
        plain = [x for x in segments if "\n" not in x]
        rest = [x for x in segments if "\n" in x]
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            feeds = np.flatnonzero(ids == self.feed)
            if len(feeds) == len(plain) - 1:
                data, cuts = ids.tobytes(), [0, *(4 * feeds + 4).tolist()]
                ends = [*(4 * feeds).tolist(), 4 * len(ids)]
                out = {x: data[a:b] for x, a, b in zip(plain, cuts, ends)}
            else:
                out, rest = {}, segments
        else:
            out = {}
        return out | dict(zip(rest, self._ids(rest), strict=True))

    def _match(self, match: str) -> bytes:
        """The ids of one match of the pattern, by the file's model."""
        if match.isascii() and match.isprintable():
            name = match.replace(" ", self.names[32])
        else:
            name = match.encode().decode("latin-1").translate(self.names)
        ids = [x.id for x in self.model.tokenize(name)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _spaced(self, word: str) -> bytes:
        """The ids of a space and a word that are one match."""
        if (ids := self.kept.get(word)) is None:
            ids = self.older.get(word) or self._match(" " + word)
            if len(word) <= LONGEST_KEPT:
                self.kept[word] = ids
        return ids

    def _bare(self, match: str) -> bytes:
        if (ids := self.bare.get(match)) is None:
            ids = self._match(match)
            if len(match) <= LONGEST_KEPT:
                self.bare[match] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """The ids of a space and a word of COMMON characters."""
        if word.isalpha():
            return self._spaced(word)
        head, *rest = self.matches(" " + word)
        return (self._spaced(head[1:]) if len(head) > 1 else self._bare(" ")) + b"".join(map(self._bare, rest))

    def _head(self, word: str) -> bytes:
        """The ids of what a text begins with."""
        if self.is_common(word):
            return b"".join(map(self._bare, self.matches(word)))
        return self._segments([word])[word]

    def encode(self, texts) -> list[bytes]:
        """Of a list or an Arrow array of texts; each is cut at its spaces. One in which white space or a special token touches a space goes to the tokenizer whole."""
        if not len(texts):
            return []
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        if len(self.kept) > self.max_cached // 2:
            self.older, self.kept = self.kept, {}
        if len(self.bare) > self.max_cached // 4:
            self.bare = {}
        texts = pc.fill_null(texts, "")
        parts = pc.split_pattern(texts, " ")
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
        begins = np.r_[0, ends[:-1]]
        coded = pc.list_flatten(parts).dictionary_encode()
        # every distinct word of these texts is looked up once
        words, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False)
        table = list(map(self.kept.get, words))
        new = [k for k, ids in enumerate(table) if ids is None]  # kept ones have been looked at
        odd = [k for k in new if not (x := words[k]) or x[0].isspace() or x[-1].isspace() or "<|" in x]
        whole = np.zeros(len(texts), bool)
        if odd:
            flags, needed = np.zeros(len(words), bool), np.zeros(len(words), bool)
            flags[odd] = True
            whole = np.logical_or.reduceat(flags[codes], begins)
            needed[codes[~np.repeat(whole, ends - begins)]] = True
            new = [k for k in new if needed[k]]
        others = []
        for k in new:
            if self.is_common(words[k]):
                table[k] = self._word(words[k])
            elif (ids := self.older.get(words[k])) is not None:
                table[k] = self.kept[words[k]] = ids
            else:
                others.append(k)
        found = self._segments([" " + words[k] for k in others])
        for k in others:
            table[k] = found[" " + words[k]]
            if len(words[k]) <= LONGEST_KEPT:
                self.kept[words[k]] = table[k]
        get, out = table.__getitem__, []
        for i, (a, b) in enumerate(zip(begins.tolist(), ends.tolist())):
            out.append(b"" if whole[i] else self._head(words[codes[a]]) + b"".join(map(get, codes[a + 1 : b].tolist())))
        at = np.flatnonzero(whole).tolist()
        for i, ids in zip(at, self._ids([texts[i].as_py() for i in at]), strict=True):
            out[i] = ids
        return out


def worker_tokens(path: str) -> Tokens:
    return held(("tokens", path), lambda: Tokens(path))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, and the ids if asked for): documents with their end token, long ones cut.

    Only the first piece of a cut document may be shorter than the capacity.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"{key} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        tokens = worker_tokens(tokenizer_path)
        for batch in small_enough(batches, 1, BATCH_BYTES):
            rows = []
            for k, ids in enumerate(tokens.encode(batch.column(1))):
                ids += end
                n = len(ids) // 4
                head = n % capacity or capacity
                cuts = [0, *range(head, n + 1, capacity)]
                rows += [(k, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), ids[4 * a : 4 * b] if with_ids else None) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            cols = list(zip(*rows)) if rows else [()] * 6
            out = [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:5]]]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(cols[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over counts: runs (length, first rank, how many, first sequence, offset).

    A group is (how many bins, first sequence): bins of one free room are interchangeable.
    """
    rooms: list[int] = []  # free rooms that have groups, ascending
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)
    runs, sequences = [], 0

    def put(room: int, n: int, first: int) -> None:
        if room:
            if not groups[room]:
                bisect.insort(rooms, room)
            groups[room].append((n, first))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                n, first = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
                take = min(n, left)
                if take < n:
                    put(room, n - take, first + take)
            else:
                # new bins, as many as the rest needs when each takes as many as fit
                room, take, first = capacity, -(-left // (capacity // length)), sequences
                sequences += take
            runs.append((length, rank, take, first, capacity - room))
            put(room - length, take, first)
            rank += take
            left -= take
    return runs


def pack_pieces(table: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """table (with a column ``length`` of 1 to capacity) plus sequence_id and offset."""
    salts = 4 * shuffle_partitions(table.sparkSession)
    salted = table.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    # at most capacity x salts rows, whatever the input's size
    by_salt = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    begins = by_salt.withColumn("_begin", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))).select("length", "_salt", F.coalesce("_begin", F.lit(0)).alias("_begin"))
    counts = {r["length"]: r["n"] for r in by_salt.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most capacity rows
    runs = sorted(plan(counts, capacity))
    lengths, ranks, _, firsts, offsets = (np.array(c, np.int64) for c in (zip(*runs) if runs else [()] * 5))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1)
    ranked = ranked.join(begins, ["length", "_salt"], "left").withColumn("_rank", F.col("_rank") + F.col("_begin")).drop("_salt", "_begin")

    fields = [f for f in ranked.schema.fields if f.name != "_rank"]
    names = [f.name for f in fields]
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches):
        # runs are ordered by (length, first rank): one search over both
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        base = np.cumsum(np.r_[0, [int(counts.get(x, 0)) for x in range(capacity + 1)]])
        slot = base[lengths] + ranks if len(lengths) else ranks
        del starts
        for b in batches:
            n, r = b.column("length").to_numpy(zero_copy_only=False), b.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(slot, base[n] + r, side="right") - 1 if len(n) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in names], pa.array(firsts[at] + r - ranks[at], pa.int64()), pa.array(offsets[at], pa.int64())], [*names, "sequence_id", "offset"])

    ship(table.sparkSession)
    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece of docs.

    Pieces are written to the checkpoint folder once: texts are not encoded again
    for the plan, the ranks and the result.
    """
    table = cut(pieces(docs, tokenizer_path, capacity, key, text))
    return pack_pieces(table, capacity, (key, "piece")).select(key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
