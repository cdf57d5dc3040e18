"""Each operator against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from gleaner.llm import best_fit_packing, byte_bpe, components, language_id, license_scan, line_dedup, lm_scoring, quality_rules, simhash, suffix_dedup, vector_graph  # noqa: E402

ODD = [None, "", " ", "\n", "a", "a", "x" * 5000, "tab\tand  spaces \n", "é中😀 end"]


def prose(rng, n, words=("the", "of", "and", "house", "river", "stone", "paper", "under", "green", "seven", "walks", "slowly", "morning", "letter")):
    return " ".join(rng.choice(words) for _ in range(n))


# --- 1 suffix dedup -------------------------------------------------------------------------


def brute_suffix(rows, length):
    seen, out = {}, {}
    for k, t in sorted(rows):
        x = (t or "").encode()
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            w = x[p : p + length]
            if seen.setdefault(w, k) < k:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out[k] = (len(x), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot, hotter", [(2000, 50), (1, 1000), (1, 1)])
def test_suffix_dedup(table, hot, hotter, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "HOTTER", hotter)
    rng = random.Random(1)
    passage = prose(rng, 14)
    texts = [*ODD, *[prose(rng, rng.randint(1, 60)) + f" {i} " + (passage if i % 3 else "") + prose(rng, rng.randint(0, 30)) for i in range(60)]]
    texts += [texts[20], texts[21] + " tail", "ab" * 300, "zab" + "ab" * 200, "é" * 100, "x" + "é" * 90]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in suffix_dedup.dedup(table(texts)).withColumn("sha", F.sha2("kept", 256)).collect()}
    assert got == brute_suffix(list(enumerate(texts)), 50)


def test_suffix_dedup_of_rows_with_one_id(spark):
    rng = random.Random(3)
    text = lambda i: " ".join(f"w{i}x{rng.randrange(10**9)}" for _ in range(30))
    a, b, c = text(1), text(2), text(3)
    rows = [(1, a), (2, a), (2, b), (2, c + b), (None, a), (None, None), (3, b)]
    n = {x: len(x) for x in (a, b, c)}
    want = [(1, n[a], 0), (2, n[a], n[a]), (2, n[b], 0), (2, n[c] + 1 + n[b], 0), (None, n[a], 0), (None, 0, 0), (3, n[b], n[b])]
    rows[3] = (2, c + " " + b)
    for column in ("pairs", "marks", "mask", "_doc", "_own", "_text"):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(column, F.length("text"))
        got = suffix_dedup.dedup(docs, carry=(column,)).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got) == Counter(want)
        assert all((r[column] or 0) == r["n_bytes"] for r in got)
    with pytest.raises(ValueError):
        suffix_dedup.dedup(docs.withColumn("kept", F.lit(1)), carry=("kept",))


def test_suffix_dedup_of_nothing(table):
    assert suffix_dedup.dedup(table([]), carry=("lang",)).collect() == []


def test_longest_previous_factor():
    rng = random.Random(2)
    for n in (0, 1, 200):
        s = [bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(n)]
        d = np.array([rng.randint(0, 30) for _ in s], np.int64)
        common = lambda x, y: next((i for i in range(6) if x[i] != y[i]), 6)
        want = [max((common(s[i], s[j]) for j in range(n) if d[j] < d[i]), default=0) for i in range(n)]
        rows = np.frombuffer(b"".join(s), np.uint8).reshape(-1, 6)
        assert suffix_dedup.lpf(rows, d).tolist() == want
        assert suffix_dedup.lpf(rows, d, 6).tolist() == [w if w == 6 else 0 for w in want]


# --- 2 packing -------------------------------------------------------------------------------


def test_packing_round_trip(table):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    texts = [*ODD, *[prose(rng, rng.choice([1, 5, 200, 900])) for _ in range(40)], prose(rng, 9000)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    rows = best_fit_packing.pack(table(texts), public_tokenizers.path("byte_bpe_50k.json")).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, ids in want.items():
        at = 0
        for i, r in enumerate(sorted(by_doc[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at) and (r["length"] == 2048 or i == 0)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for places in by_seq.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    assert len(by_seq) <= -(-sum(map(len, want.values())) // 2048) + 1
    assert best_fit_packing.pack(table([]), public_tokenizers.path("byte_bpe_50k.json")).collect() == []


@pytest.mark.parametrize("max_cached", [40, 1_000_000])
def test_ids_by_words_are_those_of_whole_texts(max_cached):
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(9)
    t, tokens = Tokenizer.from_file(path), best_fit_packing.Tokens(path, max_cached)
    odd = ["'s", "'ll", "<|endoftext|>", "<|", *"  \n\n\t\r\x0b\x1c\x7f\x85\xa0\xad\xaaº²½ßéŉſƀʰ\u0301\u2003中Ж٣😀aaabcDEF129.,'!-_|#"]
    texts = ["".join(rng.choice(odd[rng.choice([0, 0, 20]) :]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [" ".join(rng.choice(["the", "of,", "it's", "house.\nThe", "Größe", "Москва", "3.14", "a" * 90, "\"I'll"]) for _ in range(rng.randint(1, 20))) for _ in range(300)]
    want = [want_of(t, x) for x in texts]
    for step in (7, 1000, 3300):
        assert [x for i in range(0, len(texts), step) for x in tokens.encode(texts[i : i + step])] == want
    assert tokens.encode([None, "", "a"]) == [b"", b"", want_of(t, "a")]
    assert tokens.encode([]) == []


def want_of(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_reach_the_tokenizer_once_whatever_stands_beside_them():
    rng, sent = random.Random(4), []
    words = list(dict.fromkeys("".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(300)))
    tokens = best_fit_packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"))

    class Seen:
        def __init__(self, whose):
            self.whose = whose

        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return self.whose.encode_batch_fast(texts, **how)

        def tokenize(self, name):
            sent.append(name)
            return self.whose.tokenize(name)

    tokens.tokenizer, tokens.model = Seen(tokens.tokenizer), Seen(getattr(tokens, "model", None))
    got = tokens.encode([" ".join(["start", *(w + end for w in words)]) for end in ("", ".", ",", "!?", "...", ":", "'s")])
    assert len(got) == 7 and sum(map(len, sent)) < 2 * sum(map(len, words))


# --- 3 SimHash -------------------------------------------------------------------------------


def test_simhash_components(table, spark):
    rng = random.Random(4)
    base = [prose(rng, 80) for _ in range(6)]
    texts = [*ODD, *base, *[b + " end" for b in base], base[0], "one two"]
    docs = table(texts)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fp = []
    for x in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (x or "").encode().lower())
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fp.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    assert [got[i]["fp"] % 2**64 for i in range(len(texts))] == fp
    assert [got[i]["component"] for i in range(len(texts))] == [find(i) for i in range(len(texts))]


def test_ball_links_match_brute_force(spark):
    rng = random.Random(5)
    fps = {0, -1, *(rng.getrandbits(64) - 2**63 for _ in range(40))}
    for f in list(fps)[:20]:
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 3)):
                g ^= 1 << b if b < 63 else -(1 << 63)
            fps.add(g)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["component"] for r in components.components(simhash.links(df)).collect()}
    root = {f: f for f in fps}
    for a, b in itertools.combinations(sorted(fps), 2):
        if ((a ^ b) % 2**64).bit_count() <= 2 and root[a] != root[b]:
            lo, hi = sorted((root[a], root[b]))
            root = {k: lo if v == hi else v for k, v in root.items()}
    assert {f: got.get(f, f) for f in fps} == root


def test_similar_groups(table):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(12):
        w = [rng.choice(words) for _ in range(300)]
        texts.append(" ".join(w))
        w[rng.randrange(300)] = "new"
        texts.append(" ".join(w))
    texts += [texts[0], "", None, "short one", "short one", " ", "\n", "", None]
    kept = {r["doc_id"] for r in simhash.keep_one(table(texts)).collect()}
    assert kept == {*range(0, 24, 2), 25, 26, 27, 29, 30, 32}
    assert simhash.keep_one(table([])).collect() == []


def test_keep_one_of_rows_with_one_id(spark):
    rng = random.Random(13)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) for _ in range(3))
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (2, b, 4), (3, b + " more", 5), (None, c, 6), (4, c, 7), (None, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 long").withColumn("key", F.lit(0)).withColumn("row", F.lit(0)).withColumn("component", F.lit(0))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r["h1"] for r in out.collect()) == [1, 3, 4, 6, 7, 8]


def test_components_of_a_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (60, 50), (50, 60)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50}
    assert components.components(df.limit(0)).collect() == []


def test_rounds_of_components_take_tasks_by_their_edges(spark, monkeypatch):
    pairs = [(i, i + 1) for i in range(0, 60) if i % 20 != 19]
    want = {i: i // 20 * 20 for i in range(60)}
    df = spark.createDataFrame(pairs, "a long, b long").coalesce(1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in zip(before, ("40", "false", "-1")):
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("rounds", "")
        assert {r["node"]: r["component"] for r in components.components(df).collect() if r["node"] < 60} == want
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds]
        # the edges as they come, their number, and the last distinct are dealt out over the session's partitions, rounds are not
        assert sum(s.numTasks >= 40 for s in stages if s and s.numCompletedTasks) <= 10
        monkeypatch.setattr(components, "ROWS", 10)
        assert {r["node"]: r["component"] for r in components.components(df).collect()} == want
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)


def test_similar_groups_find_all_pairs_at_the_threshold(table):
    rng, texts = random.Random(8), []
    for _ in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(94)]  # 90 shingles, 10 of them changed: 80 of 100
        texts += [" ".join(words), " ".join([*words[:47], "new", *words[48:51], "new", *words[52:]])]
    sets = [set(simhash.shingle_set(t, 5).tolist()) for t in texts]
    want = {i for i in range(1, len(texts), 2) if len(sets[i] & sets[i - 1]) >= 0.8 * len(sets[i] | sets[i - 1])}
    assert len(want) == 150
    assert {r["doc_id"] for r in simhash.keep_one(table(texts)).collect()} == set(range(0, len(texts), 2))


def test_keep_one_joins_what_fingerprints_join(table):
    rng, texts = random.Random(14), []
    often = " ".join(f"w{i}" for i in range(41))
    for _ in range(2):  # most shingles by number are shared, most by kind are not
        texts.append(" ".join([often] * 60 + [f"x{rng.randrange(10**6)}" for _ in range(30)]))
    a, b = (set(simhash.shingle_set(t, 5).tolist()) for t in texts)
    assert len(a & b) < 0.8 * len(a | b)
    assert (simhash.fingerprint(texts[0], 3) ^ simhash.fingerprint(texts[1], 3)).bit_count() <= 2
    texts.append(" ".join(f"y{i}" for i in range(60)))
    assert sorted(r["doc_id"] for r in simhash.keep_one(table(texts)).collect()) == [0, 2]


def test_pairs_behind_an_unlike_least_member_are_compared(spark):
    rows = [(7, i, 10, (1, 10)) for i in (1, 2, 3, 4)] + [(8, 1, 10, (1, 10)), (8, 5, 10, (1, 10))]
    members = spark.createDataFrame(rows, "key long, id long, n long, hub struct<id: long, n: long>")
    found = spark.createDataFrame([(1, 1), (4, 1), (5, 1)], "node long, component long")
    assert {tuple(r) for r in simhash.first_pairs(members, 0.8).collect()} == {(1, 2), (1, 3), (1, 4), (1, 5)}
    assert {tuple(r) for r in simhash.other_pairs(members, found, 0.8).collect()} == {(2, 3), (2, 4), (3, 4)}


# --- 4 line dedup ----------------------------------------------------------------------------


def chunks_of(lines):
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    says = [i > 0 and (h[i - 1] * 31 + h[i]) % 2**32 % 2 == 0 for i in range(len(h))]
    out, at = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (says[i] and not says[i - 1]):
            out.append((at, i + 1))
            at = i + 1
    return out


def brute_lines(rows):
    """For (key, text) in order: (kept text, chunks, removed chunks, removed lines)."""
    parts, first, gone, n_gone = [], {}, [set() for _ in rows], [0] * len(rows)
    for d, (_, t) in enumerate(rows):
        lines = t.split("\n") if t else []
        parts.append((lines, chunks_of(lines)))
        for j, (a, b) in enumerate(parts[d][1]):
            if b - a >= 2:
                first.setdefault("\n".join(lines[a:b]), (d, j))
    for d, (lines, chunks) in enumerate(parts):
        for j, (a, b) in enumerate(chunks):
            if b - a < 2 or first["\n".join(lines[a:b])] == (d, j):
                continue
            o, k = first["\n".join(lines[a:b])]
            there, (x, y) = parts[o][0], parts[o][1][k]
            n_gone[d] += 1
            up = down = 0
            while j and k and up < min(a - chunks[j - 1][0], x - parts[o][1][k - 1][0]) and lines[a - 1 - up] == there[x - 1 - up]:
                up += 1
            while j + 1 < len(chunks) and k + 1 < len(parts[o][1]) and down < min(chunks[j + 1][1] - b, parts[o][1][k + 1][1] - y) and lines[b + down] == there[y + down]:
                down += 1
            gone[d] |= set(range(a - up, b + down))
    return [(t if t is None else "\n".join(x for i, x in enumerate(p[0]) if i not in g), sum(b - a >= 2 for a, b in p[1]), n, len(g)) for (_, t), p, g, n in zip(rows, parts, gone, n_gone)]


def test_line_dedup_matches_brute_force(table):
    rng = random.Random(7)
    shared = [[f"shared line {i} of notice {k}" for i in range(12)] for k in range(8)]
    texts = list(ODD)
    for i in range(60):
        lines = [prose(rng, 5) for _ in range(rng.randint(1, 8))]
        if i % 2:
            lines[1:1] = rng.choice(shared)
        if i % 5 == 0:
            lines += lines
        texts.append("\n".join(lines))
    texts.append(texts[12])
    docs = table(texts).withColumn("n_chunks", F.lit("mine"))
    for name in ("_key", "_gone", "lines", "row", "id", "of", "chunks"):
        docs = docs.withColumn(name, F.lit(name))
    rows = line_dedup.dedup_lines(docs).collect()
    got = {r["doc_id"]: r for r in rows}
    want = brute_lines(list(enumerate(texts)))
    assert [(got[k]["text"], got[k]["n_chunks"], got[k]["n_removed_chunks"], got[k]["n_removed_lines"]) for k in range(len(texts))] == want
    assert sum(w[2] for w in want) > 40 and all(b - a >= 2 for t in texts[9:] for a, b in chunks_of(t.split("\n"))[:-1])
    assert all(r[name] == name for r in rows for name in ("_key", "_gone", "lines", "row", "id", "of", "chunks"))
    # of a shared notice little is left but at its first place
    left = sum(got[k]["text"].count("shared line") for k in range(len(texts)) if texts[k] is not None)
    assert left <= 12 * 8 + 12
    assert line_dedup.dedup_lines(table([])).collect() == []


def test_line_dedup_shuffles_texts_once(spark, tmp_path):
    spark.createDataFrame([(i, f"a{i % 3}\nb\nc\nd") for i in range(20)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plan = line_dedup.dedup_lines(spark.read.parquet(f"{tmp_path}/docs"))._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    moved = re.findall(r" Exchange hashpartitioning\(id#[^\n]*\n[^\n]*Project \[struct\(k", plan)
    assert len(moved) == 1 and "ReusedExchange" in plan, plan


def test_line_dedup_of_rows_with_one_id(spark):
    rng = random.Random(8)
    text = lambda: "\n".join(f"{rng.random()} line" for _ in range(20))
    a, b, c = text(), text(), text()
    rows = [(1, a), (2, a), (2, b), (2, b), (None, c), (None, None), (3, c)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = Counter((r["doc_id"], r["text"]) for r in got)
    assert left[(1, a)] == 1 and left[(2, b)] == 2 and left[(None, c)] == 1 and left[(None, None)] == 1
    assert all(len(t) < 200 for (k, t), _ in left.items() if k == 3 or (k == 2 and t != b))


# --- 5 vectors -------------------------------------------------------------------------------


def test_vector_links(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16))
    v = np.concatenate([c + 0.12 * rng.standard_normal((25, 16)) for c in centres] + [rng.standard_normal((100, 16))]).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [float("inf")] * 16, [1.0, 2.0], v[3].tolist(), (2 * v[3]).tolist(), [1e-30] * 16]
    rows += [(len(rows) + i, x) for i, x in enumerate(odd)]
    got = {r["vec_id"]: r for r in vector_graph.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), min_shards=3).collect()}
    good = [i for i, x in rows if x and len(x) == 16 and None not in x and np.isfinite(x).all() and any(x)]
    u = np.array([rows[i][1] for i in good], np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    found = sum(got[i]["n_links"] for i in good)
    assert 0.97 * link.sum() <= found <= link.sum() and len(got) == len(rows)
    for i, _ in rows:
        assert got[i]["kept"] == (got[i]["component_id"] == i)
        if i not in good:
            assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert vector_graph.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def components_of(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    return [next(x for x in iter(lambda k=[i]: k.__setitem__(0, root[k[0]]) or k[0], None) if root[x] == x) for i in range(n)]


def test_vector_links_and_components_of_many_dimensions(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((150, 64))
    v = np.concatenate([c + rng.choice([0.15, 0.3, 0.36]) * rng.standard_normal((rng.integers(1, 12), 64)) for c in centres] + [rng.standard_normal((900, 64))]).astype(np.float32)
    v = v[rng.permutation(len(v))]
    got = {r["vec_id"]: r for r in vector_graph.link_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"), min_shards=4).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    n = [got[i]["n_links"] for i in range(len(v))]
    assert link.sum() > 1000 and all(a <= b for a, b in zip(n, link.sum(1))) and sum(n) >= 0.99 * link.sum()
    want = components_of(len(v), np.argwhere(np.triu(link)).tolist())
    assert np.mean([got[i]["component_id"] == want[i] for i in range(len(v))]) >= 0.99


def test_vector_audit_sees_what_searches_miss():
    rng = np.random.default_rng(10)
    v = rng.standard_normal((600, 32))
    v[300:] = v[:300] + 0.05 * rng.standard_normal((300, 32))
    _, single = vector_graph.units(v)
    graph = vector_graph.Graph(single)
    for _, layer in graph.layers:
        layer.links[:] = -1  # searches lead nowhere
    assert graph.audit(0.9) == 1.0 and graph.exact
    pairs = {(int(a), int(b)) for q, c in graph.near(single, 0.9) for a, b in zip(q, c)}
    assert all((i, i + 300) in pairs for i in range(300))


def test_vectors_ask_only_the_shards_that_may_hold_partners(spark):
    rng = np.random.default_rng(21)
    base = vector_graph.units(rng.standard_normal((3000, 64)))[0]
    v = np.concatenate([base, vector_graph.plant(base[:600], base, 0.9005)]).astype(np.float32)
    router = vector_graph.Router(base, 16, 0.9)
    asked = router.visits(v.astype(np.float64))
    assert len(router.pivots) == 16 and asked.mean() < 0.6  # every shard was asked before
    assert np.mean(asked[np.arange(3000, 3600), router.home(base[:600])]) >= 0.98
    got = {r["vec_id"]: r for r in vector_graph.link_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"), min_shards=16, shard_rows=150, block_rows=400).collect()}
    u = vector_graph.units(v.astype(np.float64))[0]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    n = np.array([got[i]["n_links"] for i in range(len(v))])
    assert link.sum() >= 1200 and (n <= link.sum(1)).all() and n.sum() >= 0.97 * link.sum()
    want = components_of(len(v), np.argwhere(np.triu(link)).tolist())
    assert np.mean([got[i]["component_id"] == want[i] for i in range(len(v))]) >= 0.99


def test_vector_beam_does_not_grow_where_partners_are_found():
    _, single = vector_graph.units(np.random.default_rng(22).standard_normal((6000, 64)))
    graph = vector_graph.Graph(single)
    assert graph.audit(0.9) == 1.0 and graph.beam == vector_graph.BEAM


def test_vectors_alike_take_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(12)
    _, single = vector_graph.units(rng.standard_normal((1, 16)) + 0.01 * rng.standard_normal((12_000, 16)))
    graph = vector_graph.Graph.__new__(vector_graph.Graph)
    graph.vectors, graph.beam, graph.m, graph.exact = single, 24, 12, False
    layer = vector_graph.Layer(len(single), 24)
    layer.links[:] = (np.arange(len(single))[:, None] + np.r_[1:25]) % len(single)
    graph.layers = [(np.arange(len(single)), layer)]
    tracemalloc.start()
    found = sum(len(q) for q, _ in graph.near(single[: graph.block()], 0.9))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == graph.block() * len(single) and peak < 200 << 20


# --- 6 language ID ---------------------------------------------------------------------------


def test_language_id(table):
    rng = random.Random(9)
    en, de = ("the", "of", "with", "house", "what"), ("der", "und", "nicht", "haus", "schön")
    texts = [prose(rng, 30, en if i % 2 else de) for i in range(80)] + [None, "", "123 !!", "the house with"]
    langs = ["en" if i % 2 else "de" for i in range(80)] + [None, None, "en", None]
    got = {r["doc_id"]: r for r in language_id.identify(table(texts, langs)).collect()}
    assert all(got[i]["lang_pred"] == langs[i] for i in range(80)) and got[83]["lang_pred"] == "en"
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (80, 81, 82)] == [("und", 0.0)] * 3
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i]["score"] <= 1 for i in got)
    assert {r["lang_pred"] for r in language_id.identify(table(["a"], [None])).collect()} == {"und"}


def test_language_id_is_naive_bayes(table):
    rng = random.Random(14)
    words = {"en": "the of with House what İstanbul".split(), "de": "der und nicht Häuser schön".split(), "zh": "语言 模型 数据 我们 的".split(), "hi": "हिन्दी भाषा में है".split()}
    langs = [rng.choice([*words, None]) for _ in range(120)]
    texts = [" ".join(rng.choice(words[x or "en"]) for _ in range(rng.randint(0, 12))) + rng.choice(["", " 12, 3!", "  "]) for x in langs]
    texts += [None, "", "a", "the " * 100_000, "\u0301", "١٢٣"]
    langs += ["en", "de", None, None, "en", None]

    def grams(text):
        x = "".join(c if c.isalpha() or __import__("unicodedata").category(c)[0] == "M" else " " for c in text.lower())
        x = [ord(c) for c in " " + "".join(w + " " for w in x.split())]
        out = []
        for n in (1, 2, 3):
            for i in range(len(x) - n + 1):
                h = 0
                for c in x[i : i + n]:
                    h = (h * 0x85EBCA6B + c) % 2**32
                h = (h + ((n - 1) << 25)) * 0x9E3779B1 % 2**32
                out.append(((h ^ h >> 15) * 0x2C1B3C6D % 2**32) >> 16)
        return out

    counts, docs = {}, Counter()
    for k, (t, x) in enumerate(zip(texts, langs)):
        if t is not None and x is not None and zlib.crc32(str(k).encode()) % 4 != 2:
            counts.setdefault(x, Counter()).update(grams(t))
            docs[x] += 1
    got = {r["doc_id"]: r for r in language_id.identify(table(texts, langs)).collect()}
    for k, t in enumerate(texts):
        if t is None or not any(map(str.isalpha, t)):
            assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
            continue
        c = Counter(grams(t))
        score = {x: np.log(docs[x] / sum(docs.values())) + sum(m * np.log((n[g] + 0.5) / (sum(n.values()) + 0.5 * 65536)) for g, m in c.items()) for x, n in counts.items()}
        best = max(score.values())
        assert score[got[k]["lang_pred"]] >= best - 1e-4 * abs(best), (k, t[:40])


def test_language_id_carries_any_column(table):
    docs = table(["the house", None]).withColumn("_text", F.lit(1)).withColumn("text2", F.col("text"))
    rows = language_id.predict(docs, language_id.train(table(["the house"] * 3)), carry=("_text", "text", "lang")).collect()
    assert [(r["_text"], r["text"], r["lang_pred"]) for r in rows] == [(1, "the house", "en"), (1, None, "und")]
    with pytest.raises(ValueError):
        language_id.predict(docs.withColumn("score", F.lit(1)), language_id.train(docs), carry=("score",))
    empty = table([])
    assert language_id.identify(empty).collect() == []


# --- 7 licenses ------------------------------------------------------------------------------


def test_license_scan(table):
    texts = [*ODD, "Under the GNU General Public License, version 3.0 or later. MIT License", "mit license mit license", "Creative Commons Attribution-ShareAlike 4.0 and cc by-nc", "the Apache License, Version 2.0"]
    got = {r["doc_id"]: r for r in license_scan.scan(table(texts)).collect()}
    n = len(ODD)
    assert got[0]["n_words"] == 0 and got[0]["labels"] == "" and got[0]["first_word"] is None and got[0]["score"] == 0
    assert set(got[n]["labels"].split(",")) == {"gpl", "gpl-3.0-or-later", "mit"} and got[n]["base_labels"] == "gpl,mit"
    assert (got[n + 1]["n_base"], got[n + 1]["first_word"], got[n + 1]["last_word"]) == (2, 0, 2)
    assert "cc-by-sa-4.0" in got[n + 2]["labels"] and got[n + 3]["labels"] == "apache,apache-2.0"
    assert len(license_scan.build_rules()) > 200


def test_license_base_places_match_brute_force(table):
    rng = random.Random(15)
    pool = "gnu general public license apache license cc by mit license GNU MIT the CC By-nc é 3 licenses".split()
    texts = [*ODD, *["".join(rng.choice(pool) + rng.choice([" ", "-", "\n", ", ", ""]) for _ in range(rng.randint(0, 40))) for _ in range(150)]]
    rows = {r["doc_id"]: r for r in license_scan.scan(table(texts).withColumn("spans", F.lit(0))).collect()}
    for k, t in enumerate(texts):
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.encode().split()]
        r = rows[k]
        want = (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want, t
        assert {x for _, x in places} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert license_scan.scan(table([])).collect() == []


def test_license_detections_within_kept_ones_go():
    rng = random.Random(16)
    machine = license_scan.scanner(license_scan.build_rules())
    words = "gpl 2 0 3 or later version v the gnu general public license lesser mit apache cc by sa nc 4 bsd clause".split()
    for _ in range(200):
        line = " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) + " "
        ids = {i for _, group in machine.machine.iter(line) for i in group}
        found = sorted(((p, m.start(), m.end(), label) for label, p, rx in (machine.rules[i] for i in ids) for m in rx.finditer(line)), key=lambda x: (-x[0], x[1] - x[2], x[1], x[3]))
        kept = []
        for p, a, b, label in found:
            if not any(x <= a and b <= y for _, _, x, y in kept):
                kept.append((label, p, a, b))
        assert machine.detect(line) == kept


def test_license_scan_of_a_long_text_takes_time_in_proportion():
    machine = license_scan.scanner(license_scan.build_rules())
    text = "licensed under the apache license, version 2.0 and the gpl 3.0 or later. " * 70_000  # 5 MB
    began = time.process_time()
    r = license_scan.scan_text(text, machine)
    assert r["n_base"] == 70_000 and len(r["spans"]) >= 140_000
    assert time.process_time() - began < 60


# --- 8 quality -------------------------------------------------------------------------------


def test_quality_rules(table):
    rng = random.Random(10)
    clean = prose(rng, 120).capitalize() + "."
    texts = [*ODD, clean, "spam " * 60, "x# " * 60, "\n".join(["the same line of text here."] * 9), clean + "\n" + clean]
    rows = {r["doc_id"]: r for r in quality_rules.add_quality(table(texts)).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))
        r = rows[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, k
        assert r["base_failed"] == (len(w) < 20 or 100 * len(hit) > 30 * len(w)) and not (r["kept"] and r["base_failed"])
    assert rows[len(ODD)]["kept"]


# --- 9 language model ------------------------------------------------------------------------


def test_lm_counts_and_probabilities(table):
    rng = random.Random(11)
    texts = [*ODD, *[prose(rng, rng.randint(1, 40)) for _ in range(60)]]
    got = {r["doc_id"]: r for r in lm_scoring.score(table(texts), head=8).collect()}
    c, n_docs = Counter(), 0
    for k, t in enumerate(texts):
        if zlib.crc32(str(k).encode()) % 10:
            c.update((t or "").encode().lower().split())
            n_docs += 1
    n, v = sum(c.values()) + n_docs, len(c) + 1
    for k, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        counts = [*(c[x] for x in w), n_docs]
        assert got[k]["base_score"] == pytest.approx(sum(np.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in counts))
        assert (got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (len(w) + 1, sum(x > 0 for x in counts), n)
        assert got[k]["score"] < 0
    assert lm_scoring.score(table([])).collect() == []


def test_lm_learns_from_all_documents(table):
    docs = table(["x"] * 5600).select("doc_id", "lang")
    late = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")) > 2600
    docs = docs.withColumn("late", late).withColumn("text", F.when(F.col("late"), F.lit("c d " * 10)).otherwise(F.lit("a b " * 10)))
    r = lm_scoring.score(docs).join(docs.select("doc_id", "late"), "doc_id").groupBy("late").agg(F.avg("score").alias("s")).collect()
    mean = {x["late"]: x["s"] for x in r}
    # one word follows from the one before: better than half the likelihood of guessing for a token
    assert mean[True] / 21 > -0.25 and mean[False] / 21 > -0.25


def test_lm_scores_held_out_texts_better_than_counts_do(table):
    rng = random.Random(17)
    follow = {w: rng.sample([f"w{i}" for i in range(60)], 3) for w in [f"w{i}" for i in range(60)]}

    def text():
        w = rng.choice(list(follow))
        out = [w]
        for _ in range(rng.randint(5, 60)):
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    rows = [r for r in lm_scoring.score(table([text() for _ in range(1200)])).collect() if r["held_out"]]
    assert len(rows) > 60
    assert sum(r["score"] for r in rows) > 0.85 * sum(r["base_score"] for r in rows)


def test_lm_takes_memory_by_tokens():
    import tracemalloc

    g = lm_scoring.new_gru(4, 3, 4)
    docs = [np.append(np.random.default_rng(i).integers(0, 10, n), 10).astype(np.int32) for i, n in enumerate([120_000, *[20] * 255])]
    tracemalloc.start()
    alone = lm_scoring.log_likelihoods(docs, g)
    lm_scoring.train(docs, g, lm_scoring.Adam(g), 0.01)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (alone < 0).all() and peak < 40 << 20


def test_frequent_words(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([9, 9, 9, 5, 5, 5000, 70000, 1, 1, 1, 1])], "h long, n long")
    for most in range(12):
        h, n = lm_scoring.frequent(counts, most)
        want = next(k for k in (11, 7, 5, 2, 1, 0) if k <= most)
        assert n.tolist() == [70000, 5000, 9, 9, 9, 5, 5, 1, 1, 1, 1][:want] and len(set(h.tolist())) == want
    assert len(lm_scoring.frequent(counts.limit(0), 5)[0]) == 0


def test_gru_gradients():
    g = lm_scoring.new_gru(4, 3, 4)
    for name in ("embed", "w", "u", "b", "classes", "words"):
        setattr(g, name, getattr(g, name).astype(np.float64))
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 12, (5, 3)), rng.integers(0, 12, (5, 3))
    fresh, live, h = np.zeros((5, 3), bool), np.ones((5, 3), bool), rng.standard_normal((4, 3))
    fresh[2, 1], live[4, 2] = True, False
    grads, _, _ = lm_scoring.train_step(g, x, y, live, h, fresh)
    for p, d in zip(g.params(), grads):
        i = tuple(rng.integers(0, s) for s in p.shape)
        old, step, cost = p[i], 1e-5, []
        for e in (step, -step):
            p[i] = old + e
            cost.append(lm_scoring.train_step(g, x, y, live, h, fresh)[2])
        p[i] = old
        assert d[i] == pytest.approx((cost[0] - cost[1]) / (2 * step), abs=1e-5)


def test_lanes_carry_the_state():
    g = lm_scoring.new_gru(4, 3, 4)
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(0, 10, n), 10).astype(np.int32) for n in (0, 1, 70, 25, 3)]
    together = lm_scoring.log_likelihoods(docs, g, lanes=2)
    alone = [lm_scoring.log_likelihoods([d], g)[0] for d in docs]
    assert together == pytest.approx(alone, rel=1e-4)


def test_known_words_are_not_gone_through_for_a_new_one():
    import sys

    v, words = lm_scoring.Vocabulary(np.array([lm_scoring.word_hash(b"a"), lm_scoring.word_hash(b"b")])), [b"a", b"b"] * 5000
    v.ids(words)
    words, lines = [*words, b"new", b"a", b"new"], [0]

    def trace(frame, event, arg):
        lines[0] += event == "line" and frame.f_code.co_name == "ids"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        got = v.ids(words).tolist()
    finally:
        sys.settrace(before)
    assert got == [0, 1] * 5000 + [2 + lm_scoring.word_hash(b"new"), 0, 2 + lm_scoring.word_hash(b"new")]
    assert lines[0] < 100


def test_words_and_ids_of_many_texts():
    import pyarrow as pa

    rng = random.Random(6)
    texts = [*ODD, " a  B\t", "É ÀB\x0bc\x0c\x1cd\x85e\xa0f\u2003g", *["".join(rng.choice("aB \n\r\té中") for _ in range(rng.randint(0, 20))) for _ in range(500)]]
    for some in ([], [None], ["a b"], texts):
        words, codes, ends = lm_scoring.distinct_words(pa.array(some, pa.string()))
        assert len(set(words)) == len(words)
        want = [(t or "").encode().lower().split() for t in some]
        assert [[words[k] for k in codes[a:b]] for a, b in zip([0, *ends], ends)] == want
        assert lm_scoring.hashes_of(words).tolist() == list(map(lm_scoring.word_hash, words))
        for side in (3, 300):
            g = lm_scoring.new_gru(2, side, side)
            got = lm_scoring.read_ids(lm_scoring.write_ids(codes % (g.size - 2), ends, g), g)
            assert [x.tolist() for x in got] == [[*(codes[a:b] % (g.size - 2)).tolist(), g.size - 2] for a, b in zip([0, *ends], ends)]


def test_lm_training_reads_no_texts(table, monkeypatch):
    given, train_on_all = [], lm_scoring.train_on_all

    def look(learning, *rest):
        given.append(dict(learning.dtypes))
        return train_on_all(learning, *rest)

    monkeypatch.setattr(lm_scoring, "train_on_all", look)
    assert lm_scoring.score(table(["a b", "b c d"] * 10)).count() == 20
    assert len(given) == 1 and "string" not in given[0].values()


@pytest.mark.parametrize("scale", [1, 500])
def test_output_is_a_distribution_whatever_its_weights(scale):
    g, rng = lm_scoring.new_gru(6, 4, 3), np.random.default_rng(3)
    g.classes *= scale
    g.words *= scale
    state = rng.standard_normal((1, 6)).astype(np.float32)
    logp = [lm_scoring.output(g, state, np.array([i]))[0] for i in range(12)]
    assert abs(np.exp(logp).sum() - 1) < 1e-5
    assert np.allclose(logp, [lm_scoring.output(g, state, np.array([i]), True)[0][0] for i in range(12)])


# --- 10 byte BPE ------------------------------------------------------------------------------


def test_byte_bpe_is_tiktoken(table):
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.PATTERN_FILE))
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(12)
    letters = "ab cde\n\t  the ing é ñ 中文 😀 <|endoftext|> 's 'll 123 !!!   \r\n ---- ===="
    texts = [*ODD, *["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(200)], "a" * 300, " " * 40]
    got = {r["doc_id"]: r for r in byte_bpe.encode_decode(table(texts), public_tokenizers.path(byte_bpe.PATTERN_FILE), public_tokenizers.PATTERN, with_ids=True).collect()}
    for k, t in enumerate(texts):
        ids = e.encode_ordinary(t or "")
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_byte_bpe_keeps_what_may_follow():
    fst = byte_bpe.Transducer(byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.PATTERN_FILE)))
    calls, apart = [], fst._apart
    fst._apart = lambda a, b: calls.append((a, b)) or apart(a, b)
    for _ in range(3):
        fst.reset()
        fst.encode(b"internationalisation")
    assert len(calls) == len(set(calls)) == len(fst.fits)


def test_byte_bpe_of_nothing(table):
    assert byte_bpe.encode_decode(table([]), public_tokenizers.path(byte_bpe.PATTERN_FILE), public_tokenizers.PATTERN).collect() == []


def test_utf8_stream():
    data = "aé中😀z".encode()
    for step in (1, 2, 3):
        s = byte_bpe.Utf8Stream()
        assert "".join(s.feed(data[i : i + step]) for i in range(0, len(data), step)) + s.close() == "aé中😀z"
    s = byte_bpe.Utf8Stream()
    assert s.feed(b"a\xe4\xb8") + s.close() == "a�"


def test_similar_groups_equal_brute_force_where_no_text_is_likest_to_all(spark):
    """Copies of copies, some without the text they come from: the groups are those of all pairs at 0.8 or more."""
    rng = np.random.default_rng(5)
    texts = []
    for family in range(3):
        base = [f"w{rng.integers(10**6)}" for _ in range(90)]
        for _ in range(60):
            words = list(base)
            for at in rng.choice(90, rng.integers(1, 7), replace=False):
                words[at] = f"x{rng.integers(40)}"  # changes that copies share
            texts.append(" ".join(words))
    sets = [set(simhash.shingle_set(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if texts[i] == texts[j] or both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = [find(i) for i in range(len(texts))]
    expected = {i: g for i, g in enumerate(groups) if groups.count(g) > 1}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in simhash.similar_groups(docs).collect()}
    assert 0 < len(expected) < len(texts)
    assert got == expected
