"""Byte-level BPE by a lazily determinised finite-state transducer, and its streaming decoder.

Encoding.  Let ``last(p)`` be the last token of the BPE encoding of a prefix p.
Two neighbouring tokens may stand together exactly if the merges leave their two
strings apart, and a token sequence is the BPE encoding exactly if all its
neighbours may.  So the last token of each prefix is the one token ending there
that may follow the last token of what is before it, and the encoding can be read
from left to right: the nondeterministic machine guesses where tokens begin, and
its determinisation keeps the *open* beginnings, those from which some token may
still grow: (node of the vocabulary's trie, last token before it).  A transition
says which beginnings stay open and which of them ends in a token here; when one
beginning is left, the tokens before it are certain and are emitted, which bounds
the lookahead by the longest token.  Subset states are made when first met and
kept in a table (state, byte) -> transition, emptied at a size bound.

Decoding.  ``Utf8Stream`` takes tokens one after another and gives text as soon as
code points are complete; the state is the unfinished sequence of at most 3 bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from gleaner.llm.common import held
from gleaner.session import ship

PATTERN_FILE = "byte_bpe_50k.tiktoken"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by its definition: join the neighbours of lowest rank, the leftmost first, until none can be joined."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """The merges as a transducer over bytes; ``max_states`` bounds the table of determinised states."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000):
        self.ranks = ranks
        self.text = {i: t for t, i in ranks.items()}
        # trie of the vocabulary: node -> {byte: node}; token[node] is the token spelled by the node, if merges can make it
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for t, i in ranks.items():
            node = 0
            for b in t:
                to = self.next[node].get(b)
                if to is None:
                    to = self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.token.append(None)
                node = to
            self.token[node] = i
        self.fits: dict[int, bool] = {}
        self.made: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.max_states = max_states
        self.reset()

    def reset(self) -> None:
        start = ((0, -1),)
        self.ids: dict[tuple, int] = {start: 0}
        self.sets: list[tuple] = [start]
        self.step: list[dict[int, tuple[int, tuple[int, ...] | None, int, int]]] = [{}]

    def _whole(self, t: int) -> bool:
        """Whether the merges turn the token's own bytes into the token."""
        if (x := self.made.get(t)) is None:
            x = self.made[t] = merged(self.text[t], self.ranks) == [t]
        return x

    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes t; None for a single byte."""
        if t not in self.halves:
            parts = [bytes([b]) for b in self.text[t]]
            while len(parts) > 2:
                i = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.halves[t] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[t]

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b apart: undo the later of the two merges again and again, and look for an earlier merge over the border."""
        key = a << 32 | b
        if (x := self.fits.get(key)) is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            x = self.fits[key] = self._apart(a, b)
        return x

    def _apart(self, a: int, b: int) -> bool:
        # a merge over the border happens if its rank is below that of the merge which made the side standing there
        # longer; at equal ranks the merge further left comes first
        before = len(self.ranks)
        while True:
            over = self.ranks.get(self.text[a] + self.text[b])
            if over is not None and over < before:
                return False
            left, right = self._halves(a), self._halves(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                before, a = a, left[1]
            else:
                before, b = b + 1, right[0]

    def _determinise(self, state: int, byte: int) -> tuple[int, tuple[int, ...] | None, int, int]:
        """(next state, which open beginnings stay (None: all), the one whose token ends here, that token)."""
        subset, stay, source, token = [], [], -1, -1
        for i, (node, last) in enumerate(self.sets[state]):
            to = self.next[node].get(byte)
            if to is None:
                continue
            if self.next[to]:  # open only while longer tokens can grow from it
                subset.append((to, last))
                stay.append(i)
            t = self.token[to]
            if source < 0 and t is not None and self._whole(t) and (last < 0 or self._may_follow(last, t)):
                source, token = i, t
        if source < 0:
            raise ValueError("the vocabulary does not hold every byte")
        subset.append((0, token))
        key = tuple(subset)
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
        found = self.step[state][byte] = (to, None if len(stay) == len(self.sets[state]) else tuple(stay), source, token)
        return found

    def encode(self, piece: bytes) -> list[int]:
        """The ids; what every open beginning shares is put out as soon as one beginning is left."""
        if len(self.sets) > self.max_states:
            self.reset()
        step, state, out = self.step, 0, []
        waiting: list = [None]  # by open beginning: the tokens before it, as (the ones before, token)
        for byte in piece:
            state, stay, source, token = step[state].get(byte) or self._determinise(state, byte)
            chain = (waiting[source], token)
            if stay is None:
                waiting.append(chain)
            elif stay:
                waiting = [waiting[i] for i in stay]
                waiting.append(chain)
            else:
                out += unwound(chain)
                waiting = [None]
        return out + unwound(waiting[-1])


def unwound(chain) -> list[int]:
    out = []
    while chain is not None:
        chain, token = chain
        out.append(token)
    out.reverse()
    return out


class Utf8Stream:
    """Bytes in, text out as soon as code points are complete; malformed input becomes U+FFFD."""

    def __init__(self):
        self.rest = b""

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            lead = data[cut - back]
            if lead < 0x80:
                break
            if lead >= 0xC0:  # a lead byte: its sequence is complete if it has as many bytes as it says
                if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    cut -= back
                break
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.rest = self.rest.decode("utf-8", "replace"), b""
        return out


class Codec:
    """Texts to ids and back; segments (a space and what follows it up to the next) are kept with their ids up to ``max_cached``.

    No match of the pattern holds white space after something else, so segments that
    neither begin nor end with white space are encoded by themselves.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_cached: int = 400_000, max_states: int = 250_000):
        import regex

        self.pattern = regex.compile(pattern)
        self.segment = regex.compile(r"\s*\S+|\s+")
        self.fst = Transducer(ranks, max_states)
        self.max_cached = max_cached
        self.kept: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.matches: dict[str, tuple[int, ...]] = {}
        self.bytes_of = self.fst.text

    def _encode_segment(self, segment: str) -> tuple[int, ...]:
        found = self.pattern.findall(segment)
        if len(found) == 1:
            return tuple(self.fst.encode(segment.encode()))
        out: list[int] = []
        for m in found:
            ids = self.matches.get(m)
            if ids is None:
                if len(self.matches) > self.max_cached // 4:
                    self.matches.clear()
                ids = tuple(self.fst.encode(m.encode()))
                if len(m) <= 64:
                    self.matches[m] = ids
            out += ids
        return tuple(out)

    def encode(self, text: str) -> list[tuple[int, ...]]:
        """The ids by segment: a text is cut at its spaces, unless white space touches one of them."""
        if not text:
            return []
        parts = text.split(" ")
        kept = self.kept
        out = list(map(kept.get, parts))
        if None in out:
            if len(kept) > self.max_cached // 2:  # two generations: what was used lately stays
                self.older, self.kept = kept, {}
                kept = self.kept
            for k, ids in enumerate(out):
                if ids is None:
                    part = parts[k]
                    ids = kept.get(part)
                    if ids is None:
                        if not part or part[0].isspace() or part[-1].isspace():
                            return [self._encode_segment(x) for x in self.segment.findall(text)]
                        ids = self.older.get(part) or self._encode_segment(" " + part)
                        if len(part) <= 64:
                            kept[part] = ids
                    out[k] = ids
        out[0] = self._encode_segment(parts[0])  # no space before
        return out

    def decode(self, ids: list[int], step: int = 65536) -> Iterator[str]:
        """Text, piece by piece, from ids in the order given."""
        stream, table = Utf8Stream(), self.bytes_of
        for k in range(0, len(ids), step):
            yield stream.feed(b"".join(map(table.__getitem__, ids[k : k + step])))
        yield stream.close()


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, and ids if asked for) of every row.

    A null text counts as empty: no tokens, and the digests of nothing.  Ties and
    repeated rows need no rule, each row is coded by itself; other columns of docs
    are not read.  The vocabulary (fixed size) is read once by each Python worker.
    """
    import itertools

    import pyarrow as pa

    schema = f"{key} {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        codec = worker_codec(ranks_path, pattern)
        for batch in batches:
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for t in batch.column(1):
                ids = list(itertools.chain.from_iterable(codec.encode(t.as_py() or "")))
                sha = hashlib.sha256()
                for piece in codec.decode(ids):
                    sha.update(piece.encode())
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(" ".join(map(codec.name_of, ids)).encode()).hexdigest())
                rows["decoded_sha256"].append(sha.hexdigest())
                if with_ids:
                    rows["ids"].append(ids)
            cols = [batch.column(0), pa.array(rows["n_tokens"], pa.int64()), pa.array(rows["ids_sha256"]), pa.array(rows["decoded_sha256"])]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, schema)


def worker_codec(ranks_path: str, pattern: str) -> Codec:
    """The worker's own codec."""

    def make() -> Codec:
        codec = Codec(load_ranks(ranks_path), pattern)
        codec.name_of = {i: str(i) for i in codec.bytes_of}.__getitem__
        return codec

    return held(("codec", ranks_path, pattern), make)
