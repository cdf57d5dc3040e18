"""Language-model scoring: corpus counts and a gated recurrent network in numpy.

Counts.  Every task counts its training words by parts of WORD_BYTES of text; word hashes
(62 bits of XXH64) and counts are added up by a shuffle that grows with the corpus.
The most frequent words, HEAD at most, are broadcast; the other tokens of a text meet
their counts in a join on the word's hash.  After the counts texts are read once more: the
network's ids of their words are written to the checkpoint folder, and all rounds of
training and the scoring read these.

Network.  One GRU layer reads the tokens; the output is factored into classes of
equal size over the most frequent words, the end and the class of all other words:
p(token) = p(class) p(token | class).  Another word's probability is that of the
class of others times its smoothed share of their counts, so the model gives every
token a probability and these add up to 1 over the known words and one unknown.
Training is truncated backpropagation through windows of WINDOW tokens with Adam, over
all tokens of all training documents: in each of ROUNDS rounds every task trains a copy
of the network on its share of the documents, and the copies are averaged by their
tokens.  In training a document of more than STRETCH tokens is several stretches, each
read from an empty state.  The named words grow as the square root of the number of
distinct ones.  The score depends on how rows are dealt to tasks.  Scoring carries the
state from window to window, so a document's log-likelihood is that of its complete
text, however long.  Documents of a batch run side by side in lanes.

A null text is an empty text: one token, the end.  Without training documents
(N = 0) all counts are 0 and the network stays as it was initialised.  Rows with an
equal doc_id are scored each by itself.  A text of any length takes memory in
proportion to its tokens.  Other columns of the input are not read.
"""

from __future__ import annotations

import math
import uuid
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import cut, held, let_go
from gleaner.llm.language_id import held_out
from gleaner.session import ship

HEAD = 200_000
CLASSES, PER_CLASS, HIDDEN = 32, 32, 24
WINDOW, LANES = 24, 256
TRAIN_LANES = 256
#: Bytes of text whose documents run side by side (of ids a fourth); tokens that one lane takes of a document in training.
BATCH_BYTES, STRETCH = 32 << 20, 1536
#: Bytes of text whose distinct words are looked up together.
WORD_BYTES = 16 << 20
#: Each round trains on another share of the documents.
ROUNDS, RATE = 4, 0.01
#: A task learns from as many tokens as these in a round, where there are so many; fewer in all are gone through again, up to PASSES times.
TASK_TOKENS, FEW_TOKENS, PASSES = 1_000_000, 2_000_000, 8
#: Numbers of a network that are averaged as one row.
BLOCK = 4096


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) >> 2


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) >> np.uint64(2)).astype(np.int64)


def distinct_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(the distinct words of all texts, the place among them of each word of each text, where each text's words end). A-Z are lower-cased, texts split at space and 9 to 13."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    coded = pc.list_flatten(parts).dictionary_encode()
    words, codes = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False)
    if b"" in words:  # before leading white space, after trailing white space
        empty = words.index(b"")
        real = codes != empty
        ends = np.r_[0, np.cumsum(real)][ends]
        codes = codes[real]
        codes = codes - (codes > empty)
        words.pop(empty)
    return words, codes, ends


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h, n): every word's hash and count over docs."""

    def run(batches):
        let_go()
        for b in small_enough(batches, 0, WORD_BYTES):
            words, codes, _ = distinct_words(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(hashes_of(words)), pa.array(np.bincount(codes, minlength=len(words)))], ["h", "n"])

    ship(docs.sparkSession)
    return docs.select(text).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Gru:
    """Single precision parameters; ids: ranks of words, then END, then OTHER as the last two of the vocabulary."""

    embed: np.ndarray  # vocabulary x hidden
    w: np.ndarray  # hidden x 3 hidden: update, reset, candidate
    u: np.ndarray
    b: np.ndarray
    classes: np.ndarray  # hidden + 1 x classes
    words: np.ndarray  # classes x hidden + 1 x per class

    @property
    def hidden(self) -> int:
        return self.u.shape[0]

    @property
    def per_class(self) -> int:
        return self.words.shape[2]

    @property
    def size(self) -> int:
        return self.words.shape[0] * self.words.shape[2]

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.w, self.u, self.b, self.classes, self.words]


def new_gru(hidden: int = HIDDEN, classes: int = CLASSES, per_class: int = PER_CLASS, seed: int = 5) -> Gru:
    rng = np.random.default_rng(seed)
    r = lambda *shape: (rng.standard_normal(shape) / math.sqrt(hidden)).astype(np.float32)
    return Gru(r(classes * per_class, hidden), r(hidden, 3 * hidden), r(hidden, 3 * hidden), np.zeros(3 * hidden, np.float32), r(hidden + 1, classes) * np.float32(0.1), r(classes, hidden + 1, per_class) * np.float32(0.1))


#: Exponentials of values within it, and sums of them, are far from the ends of single precision.
SAFE = 40


def _exp(x: np.ndarray) -> np.ndarray:
    """Exponentials in place, by row up to a factor; the sums of the rows."""
    if not x.size or x.max() > SAFE or x.min() < -SAFE:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def weights(g: Gru) -> tuple[np.ndarray, np.ndarray]:
    """(3 hidden x vocabulary, 3 hidden x hidden): those of the gates with the sign that their exponential takes."""
    table, u = np.ascontiguousarray((g.embed @ g.w + g.b).T), np.ascontiguousarray(g.u.T)
    table[: 2 * g.hidden] *= -1
    u[: 2 * g.hidden] *= -1
    return table, u


def forward(by: tuple[np.ndarray, np.ndarray], inputs: np.ndarray, h: np.ndarray, fresh: np.ndarray, keep: bool = False):
    """(states after each step, the last one; and, to be kept: states before, gates and candidates, recurrent part of the candidates).

    inputs, fresh: steps x lanes; fresh lanes start a document.  States are steps x hidden x lanes, so that all arrays of a step are whole.
    """
    table, u = by
    n = u.shape[1]
    work = np.empty((len(inputs), 3 * n, inputs.shape[1]), table.dtype)  # becomes update gate, reset gate, candidate
    for x, ids in zip(work, inputs):
        np.take(table, ids, axis=1, out=x, mode="clip")  # all ids are of the vocabulary
    after = np.empty((len(inputs), n, inputs.shape[1]), table.dtype)
    before, part = (np.empty_like(after), np.empty_like(after)) if keep else (None, None)
    starts = fresh.any(1)
    with np.errstate(over="ignore"):
        for t, x in enumerate(work):
            if starts[t]:
                h = np.where(fresh[t], table.dtype.type(0), h)
            m = u @ h
            gates, c, own = x[: 2 * n], x[2 * n :], m[2 * n :]
            if keep:
                before[t], part[t] = h, own
            gates += m[: 2 * n]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            own *= gates[n:]
            c += own
            np.tanh(c, out=c)
            step = c - h
            step *= gates[:n]
            h = np.add(h, step, out=after[t])
    return after, h.copy(), before, work, part


def output(g: Gru, states: np.ndarray, targets: np.ndarray, grads: bool = False):
    """(natural log-probabilities, gradient of the states, of the classes, of the words) for states x hidden."""
    cls, within = np.divmod(targets, g.per_class)
    order = np.argsort(cls, kind="stable")
    cls, within, rows = cls[order], within[order], np.arange(len(states))
    one = np.empty((len(states), g.hidden + 1), states.dtype)
    one[:, :-1] = states[order]
    one[:, -1] = 1
    bounds = np.searchsorted(cls, np.arange(len(g.words) + 1)).tolist()
    parts = [(k, slice(i, j)) for k, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j]
    p, q = one @ g.classes, np.empty((len(states), g.per_class), states.dtype)
    for k, part in parts:
        np.matmul(one[part], g.words[k], out=q[part])
    p_sum, q_sum = _exp(p), _exp(q)
    logp = np.empty(len(states))
    logp[order] = np.log(p[rows, cls] / p_sum + 1e-30) + np.log(q[rows, within] / q_sum + 1e-30)
    if not grads:
        return logp
    p /= p_sum[:, None]
    q /= q_sum[:, None]
    p[rows, cls] -= 1
    q[rows, within] -= 1
    d_one, d_words = p @ g.classes.T, np.zeros_like(g.words)
    for k, part in parts:
        np.matmul(one[part].T, q[part], out=d_words[k])
        d_one[part] += q[part] @ g.words[k].T
    d_states = np.empty_like(states)
    d_states[order] = d_one[:, :-1]
    return logp, d_states, one.T @ p, d_words


def train_step(g: Gru, inputs: np.ndarray, targets: np.ndarray, live: np.ndarray, h: np.ndarray, fresh: np.ndarray):
    """(gradients, last state, mean loss) of one window: backpropagation is cut at its start."""
    n = g.hidden
    after, last, before, work, part = forward(weights(g), inputs, h, fresh, True)
    rows = lambda x: x.transpose(0, 2, 1).reshape(inputs.size, -1)
    at = np.flatnonzero(live.reshape(-1))
    logp, d, d_classes, d_words = output(g, rows(after)[at], targets.reshape(-1)[at], True)
    d_states = np.zeros((inputs.size, n), after.dtype)
    d_states[at] = d
    d_states = np.ascontiguousarray(d_states.reshape(*inputs.shape, n).transpose(0, 2, 1))
    # what a step's gradient is multiplied by on its way to the gates and the candidate is known for all steps
    z, r, c = work[:, :n], work[:, n : 2 * n], work[:, 2 * n :]
    keep = 1 - z
    to_c = z * (1 - c * c)
    factors = np.empty((len(inputs), 3, n, inputs.shape[1]), after.dtype)
    np.multiply((c - before) * z, keep, out=factors[:, 0])
    np.multiply(to_c, r, out=factors[:, 2])
    np.multiply(factors[:, 2] * part, 1 - r, out=factors[:, 1])
    dh, starts = np.zeros_like(last), fresh.any(1)
    for t in range(len(inputs) - 1, -1, -1):
        dh += d_states[t]
        d_states[t] = dh
        factors[t] *= dh
        dh *= keep[t]
        dh += g.u @ factors[t].reshape(3 * n, -1)
        if starts[t]:
            dh[:, fresh[t]] = 0
    d_m = factors.reshape(len(inputs), 3 * n, -1)
    d_u = np.matmul(before, d_m.transpose(0, 2, 1)).sum(0)
    np.multiply(d_states, to_c, out=factors[:, 2])
    # the rows of each input are added up at once
    used = inputs.reshape(-1)
    order = np.argsort(used, kind="stable")
    ids, starts = np.unique(used[order], return_index=True)
    by_input = np.take(d_m.transpose(1, 0, 2).reshape(3 * n, -1), order, axis=1)
    d_rows = np.ascontiguousarray(np.add.reduceat(by_input, starts, axis=1).T)
    d_embed = np.zeros_like(g.embed)
    d_embed[ids] = d_rows @ g.w.T
    n = max(1, len(at))
    grads = [d_embed, g.embed[ids].T @ d_rows, d_u, d_rows.sum(0), d_classes, d_words]
    return [x / n for x in grads], last, -float(logp.mean()) if len(at) else 0.0


class Lanes:
    """Documents (arrays of target ids, each ending with the end) laid end to end in lanes, the longest lane first.

    There are no more lanes than the longest document leaves full.  Tokens are held once, lane after lane; a window is
    laid out when it is read.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int, end: int):
        import heapq

        longest = max(map(len, docs), default=1)
        heap = [(0, i) for i in range(max(1, min(lanes, len(docs), -(-sum(map(len, docs)) // longest))))]
        rows: list[list[int]] = [[] for _ in heap]
        for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            n, k = heap[0]
            rows[k].append(i)
            heapq.heapreplace(heap, (n + len(docs[i]), k))
        rows.sort(key=lambda r: -sum(len(docs[i]) for i in r))
        self.order = [i for r in rows for i in r]
        self.lengths = np.array([sum(len(docs[i]) for i in r) for r in rows])
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.starts = np.cumsum([0, *(len(docs[i]) for i in self.order)])[:-1]
        self.targets = np.concatenate([docs[i] for i in self.order]) if docs else np.zeros(0, np.int32)
        self.inputs = np.roll(self.targets, 1)
        self.inputs[self.starts] = end
        self.fresh = np.zeros(len(self.targets), bool)
        self.fresh[self.starts] = True

    def windows(self, width: int):
        """(places of the tokens, steps x lanes that still have some; whether there is one)."""
        for at in range(0, int(self.lengths.max(initial=0)), width):
            k = int((self.lengths > at).sum())
            steps = np.arange(at, min(at + width, int(self.lengths[0])))[:, None]
            live = steps < self.lengths[:k]
            yield np.where(live, steps, 0) + self.begins[:k], live


class Adam:
    """Steps of one network, its gradients' norm bounded by 1. The network's parameters become views of one array."""

    def __init__(self, g: Gru):
        self.step, at = 0, 0
        self.flat = np.concatenate([p.reshape(-1) for p in g.params()])
        for name, p in zip(("embed", "w", "u", "b", "classes", "words"), g.params()):
            setattr(g, name, self.flat[at : at + p.size].reshape(p.shape))
            at += p.size
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def update(self, grads: list[np.ndarray], rate: float) -> None:
        x, m, v = np.concatenate([x.reshape(-1) for x in grads]), self.m, self.v
        self.step += 1
        x *= x.dtype.type(min(1.0, 1.0 / (math.sqrt(float(x @ x)) + 1e-9)))
        y = x - m
        y *= np.float32(0.1)
        m += y
        x *= x
        x -= v
        x *= np.float32(0.01)
        v += x
        np.multiply(v, np.float32(1 / (1 - 0.99**self.step)), out=x)
        np.sqrt(x, out=x)
        x += np.float32(1e-6)
        np.divide(m, x, out=y)
        y *= np.float32(rate / (1 - 0.9**self.step))
        self.flat -= y


def train(docs: list[np.ndarray], g: Gru, adam: Adam, rate: float) -> None:
    """One pass over the windows of docs. Long documents are read by stretches side by side, each from an empty state."""
    lanes = Lanes([x[at : at + STRETCH] for x in docs for at in range(0, len(x), STRETCH)], TRAIN_LANES, g.size - 2)
    h = np.zeros((g.hidden, len(lanes.lengths)), np.float32)
    for at, live in lanes.windows(WINDOW):
        grads, h, _ = train_step(g, lanes.inputs[at], lanes.targets[at], live, h[:, : at.shape[1]], lanes.fresh[at] & live)
        adam.update(grads, rate)


def train_on_all(learning: DataFrame, g: Gru, total: int, key: str) -> int:
    """Trains g on all rows of learning (key, ids), which have total tokens; the number of tokens seen."""
    spark, seen = learning.sparkSession, 0
    tasks, passes = max(1, total // (ROUNDS * TASK_TOKENS)), max(1, min(PASSES, -(-FEW_TOKENS // max(1, total))))
    ship(spark)
    for number in range(ROUNDS):
        now, rate = spark.sparkContext.broadcast(g), RATE * (1 - 0.9 * number / ROUNDS)

        def run(batches, now=now, rate=rate):
            let_go()
            own, n = deepcopy(now.value), 0  # a worker's other tasks read the same value
            adam = Adam(own)
            for some in small_enough(batches, 0, BATCH_BYTES // 4):
                docs = read_ids(some.column(0), own)
                n += sum(map(len, docs))
                for _ in range(passes):
                    train(docs, own, adam, rate)
            if n:
                flat = np.concatenate([x.reshape(-1) for x in own.params()])
                parts = [flat[at : at + BLOCK].tobytes() for at in range(0, len(flat), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["block", "n", "x"])

        def mean(table):
            weights = table["n"].to_numpy()
            total = sum(w * np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for w, x in zip(weights, table["x"]))
            return pa.table({"block": table["block"].slice(0, 1), "n": pa.array([int(weights.sum())], pa.int64()), "x": pa.array([(total / weights.sum()).astype(np.float32).tobytes()], pa.binary())})

        share = learning.filter(F.pmod(F.xxhash64(F.lit("round"), F.col(key)), F.lit(ROUNDS)) == number).select("ids").coalesce(tasks)
        # as many rows as a network has blocks, whatever the number of tasks
        rows = sorted(share.mapInArrow(run, "block int, n long, x binary").groupBy("block").applyInArrow(mean, "block int, n long, x binary").collect(), key=lambda r: r["block"])
        if rows:
            seen += rows[0]["n"]
            flat, at = np.concatenate([np.frombuffer(r["x"], np.float32) for r in rows]), 0
            for p in g.params():
                p[...] = flat[at : at + p.size].reshape(p.shape)
                at += p.size
        now.unpersist()
    return seen


def log_likelihoods(docs: list[np.ndarray], g: Gru, lanes: int = LANES) -> np.ndarray:
    """Natural log-likelihood of each document; the state runs through all its windows."""
    laid, out = Lanes(docs, lanes, g.size - 2), np.zeros(len(docs))
    h = np.zeros((g.hidden, len(laid.lengths)), np.float32)
    by, by_token = weights(g), np.empty(len(laid.targets))
    for at, live in laid.windows(WINDOW):
        states, h, *_ = forward(by, laid.inputs[at], h[:, : at.shape[1]], laid.fresh[at] & live)
        by_token[at[live]] = output(g, states.transpose(0, 2, 1)[live], laid.targets[at[live]])
    if docs:
        out[laid.order] = np.add.reduceat(by_token, laid.starts)
    return out


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the most frequent words, best first: all words of a count or none, ``most`` at most in all."""
    n = F.col("n")
    level = F.when(n < 4096, n).otherwise(F.lit(4096) + F.floor(F.log2("n") * 64)).cast("int")
    sizes = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)  # some 8,000 rows at most
    least, left = 1 << 30, most
    for r in sizes:
        if r["count"] > left:
            break
        least, left = r["level"], left - r["count"]
    rows = counts.filter(level >= least).toPandas()  # ``most`` rows at most
    rows = rows.sort_values(["n", "h"], ascending=[False, True])
    return rows["h"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def small_enough(batches, column: int, most: int = BATCH_BYTES):
    """The rows of batches in parts of about ``most`` bytes of text: many documents side by side, and bounded memory."""
    for b in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
            yield b.slice(at, end - at)
            at = end


class Vocabulary:
    """The head words by hash, as a worker uses them: word -> rank, or HEAD-size + hash for all others."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.n = len(hashes)

    def ids(self, words: list[bytes]) -> np.ndarray:
        h = hashes_of(words)
        if not self.n:
            return h
        at = np.minimum(np.searchsorted(self.sorted, h), self.n - 1)
        return np.where(self.sorted[at] == h, self.order[at], self.n + h)


def id_type(g: Gru) -> np.dtype:
    return np.dtype("<u2" if g.size <= 1 << 16 else "<u4")


def write_ids(ids: np.ndarray, ends: np.ndarray, g: Gru) -> pa.Array:
    """The network's ids of documents as binary values, from their words' ids laid end to end; the end is put after each."""
    kind, docs = id_type(g), np.arange(len(ends))
    flat = np.full(len(ids) + len(ends), g.size - 2, kind)
    flat[np.arange(len(ids)) + np.repeat(docs, np.diff(ends, prepend=0))] = ids
    cuts = np.r_[0, (ends + docs + 1) * kind.itemsize].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(flat)])


def read_ids(column: pa.Array, g: Gru) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), id_type(g)).astype(np.int32) for x in column]


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, fold: int = 0, head: int = HEAD) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    out_of = F.coalesce(held_out(F.col(key), folds, fold), F.lit(False))
    learning = docs.select(key, text).filter(~out_of)
    counts = cut(count_words(learning, text))
    n_docs = learning.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = words + n_docs, distinct + (n_docs > 0)
    # classes and words of a class as the fourth root of the distinct words, each
    side = max(CLASSES, math.ceil(distinct**0.25))
    if side > CLASSES:
        head = max(head, side * side - 2)
    hashes, freq = frequent(counts, head)
    g, tag = new_gru(classes=side, per_class=side), uuid.uuid4().hex
    named = g.size - 2
    # mass of the words that the network has no name for: their counts, smoothed, and one unknown
    others = float(words - freq[:named].sum()) + 0.1 * (distinct - min(named, distinct)) + 0.1
    below = total + 0.1 * (kinds + 1)
    shared = spark.sparkContext.broadcast((hashes, np.log10(freq + 0.1)))
    end_cost = math.log10((n_docs + 0.1) / below)
    kind = dict(docs.dtypes)[key]
    ln10, n_head = math.log(10), len(hashes)

    def read(batches):
        hashes, logs = shared.value
        vocabulary, logs = worker_vocabulary(tag, hashes), np.r_[logs, 0.0]
        for b in small_enough(batches, 1, WORD_BYTES):
            words, codes, ends = distinct_words(b.column(1))
            ids, n, rows = vocabulary.ids(words), np.diff(ends, prepend=0), b.num_rows
            of_head, log = ids < n_head, logs[np.minimum(ids, n_head)]
            doc = np.repeat(np.arange(rows), n)
            summed = lambda x: np.bincount(doc, weights=x[codes], minlength=rows)
            heads = summed(of_head).astype(np.int64)
            # what the words without a name add to their class's share
            fixed = summed(np.where(ids >= named, log - math.log10(others), 0.0))
            rest = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n - heads)], pa.int32()), pa.array((ids - n_head)[codes[~of_head[codes]]]))
            network = write_ids(np.where(ids < named, ids, named + 1)[codes], ends, g)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n + 1), pa.array(heads), pa.array(summed(log) - n * math.log10(below) + end_cost), pa.array(fixed), rest, network], [key, "tokens", "heads", "base", "fixed", "rest", "ids"])

    ship(spark)
    tokens = cut(docs.select(key, text).mapInArrow(read, f"{key} {kind}, tokens long, heads long, base double, fixed double, rest array<long>, ids binary")).withColumn("_row", F.monotonically_increasing_id())
    if n_docs:
        train_on_all(tokens.filter(~out_of).select(key, "ids"), g, int(total), key)
    trained = spark.sparkContext.broadcast(g)

    def run(batches):
        let_go()
        g = trained.value
        for b in small_enough(batches, 6, BATCH_BYTES // 4):
            likelihood = log_likelihoods(read_ids(b.column(6), g), g) / ln10
            score = likelihood + b.column(4).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(score), b.column(5)], [key, "tokens", "heads", "base", "score", "_row"])

    scored = cut(tokens.select(key, "tokens", "heads", "base", "fixed", "_row", "ids").mapInArrow(run, f"{key} {kind}, tokens long, heads long, base double, score double, _row long"))
    tail = tokens.select("_row", F.explode("rest").alias("h")).join(counts, "h", "left")
    tail = tail.groupBy("_row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("_logs"), F.count("n").alias("_known"))
    out = scored.join(tail, "_row", "left")
    logs, known = F.coalesce("_logs", F.lit(0.0)), F.coalesce("_known", F.lit(0))
    return out.select(
        key,
        out_of.alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.col("heads") + known + F.lit(int(n_docs > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def worker_vocabulary(tag: str, hashes: np.ndarray) -> Vocabulary:
    """The worker's own table, made once for a run."""
    return held(("vocabulary", tag), lambda: Vocabulary(hashes))
