"""Operators against traced expectations and brute force."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gleaner import config
from gleaner.functions import text as T
from gleaner.operators import cards, concepts, folds, provider, qa, sections, similarity
from gleaner.plans import deep
from gleaner.sources import files

MD = "# 检索增强生成系统\n\n## 背景\n\n" + "检索增强生成系统需要评估。直接从单个 chunk 生成问题容易得到碎片化问答。\n\n## 方法\n\n系统可以先抽取概念与事实。\n"
TXT = "SYSTEM OVERVIEW\n\nThe builder reads Markdown and text files.\n\nPROCESS\n\nThe pipeline first maps the structure, then it extracts the concepts, and finally generates QA pairs.\n"


def docs(spark, rows):
    return spark.createDataFrame([(f"d{i}", n, n, "." + n.rsplit(".", 1)[1], t) for i, (n, t) in enumerate(rows)], "doc_id string, file_path string, file_name string, file_type string, text string")


def test_heading_sections(spark):
    got = {(r["doc_id"], r["title"]): r for r in sections.heading_sections(docs(spark, [("a.md", MD), ("b.txt", TXT), ("c.md", "no heading"), ("e.txt", "")])).collect()}
    assert got["d0", "背景"]["section_path"] == ["检索增强生成系统", "背景"] and got["d0", "背景"]["level"] == 2
    assert MD[got["d0", "方法"]["char_start"] : got["d0", "方法"]["char_end"]].strip() == got["d0", "方法"]["text"]
    assert [k[1] for k in got if k[0] == "d1"] == ["PROCESS"]
    assert ("d2", None) in got and ("d3", None) in got


def test_nested_markdown_paths(spark):
    text = "# A\nx\n### B\ny\n## C\nz\n# D\nw\n"
    got = {r["title"]: r["section_path"] for r in sections.markdown_sections(docs(spark, [("a.md", text)])).collect()}
    assert got == {"A": ["A"], "B": ["A", "B"], "C": ["A", "C"], "D": ["D"]}


def test_cards_of_the_text_fixture(spark):
    text = "SYSTEM OVERVIEW\n\nThe builder reads Markdown and plain text files from a folder.\n\nPROCESS\n\nThe pipeline first maps the structure, then extracts concepts and facts, and finally generates QA pairs.\n\nCONSTRAINTS\n\nEvery answer must be supported by evidence.\n"
    rows = cards.heuristic_cards(sections.units(sections.semantic_sections(docs(spark, [("a.txt", text)])))).orderBy("ord").collect()
    assert [r["card_type"] for r in rows][:1] == ["core_claim"] and rows[0]["subject"].startswith("SYSTEM OVERVIEW") and rows[0]["quality_score"] == 0.55
    for r in rows:
        assert r["evidence_ids"] and r["evidence_end"] - r["evidence_start"] == len(r["claim"])


def test_clean_pages(spark):
    text = "Running Head\nfirst line of a para-\ngraph goes on\nRunning Head\n12\nmail a@b.c\nRunning Head\nThe end.\n\nNext paragraph."
    late = "x " * 3000
    rows = [(0, text), (1, ""), (2, None), (3, "Title 😀\n\nAbstract\n\nWe say."), (4, f"{late}\n\nReferences\n\nA paper."), (5, "some references early\n\nReferences\n\nrest")]
    got = {r["k"]: r["text"] for r in sections.cleaned(spark.createDataFrame(rows, "k int, text string")).collect()}
    assert got[0] == "first line of a paragraph goes on The end.\n\nNext paragraph."
    assert got[1] == got[2] == "" and got[3].startswith("Abstract") and got[4] == late.strip() and got[5].endswith("rest")


def test_unwrap_and_units_text(spark):
    rows = [("a\r\nb\n\n\nc", "a\nb\n\nc"), ("", ""), ("a long line that goes on and on for a while to be sure\nand on\n# Head\n1. item that is longer than forty characters, it is\nrest of it", "a long line that goes on and on for a while to be sure and on\n# Head\n1. item that is longer than forty characters, it is rest of it"), ("a hyphen-\nated word", "a hyphenated word")]
    got = spark.createDataFrame(rows, "t string, want string").select(T.unwrap_lines(F.col("t")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    t = spark.createDataFrame([("keep this\nmail me@x.y\nCopyright 2020",), ("only@this",)], "t string").select(T.clean_unit(F.col("t")).alias("u"), T.clean_for_knowledge(F.concat(F.lit("x\nAbstract\n"), "t")).alias("k")).collect()
    assert [r["u"] for r in t] == ["keep this", "only@this"] and t[0]["k"] == "Abstract\nkeep this"


def test_section_titles(spark):
    rows = [("# Head\nbody", "# Head"), ("A sentence here. Another one.", "A sentence here"), ("...", "Semantic section 7"), ("x" * 100, "x" * 72)]
    got = spark.createDataFrame(rows, "t string, want string").select(T.section_title(F.col("t"), F.lit(7)).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_boundary_scores_match_mean_vectors():
    import math
    from collections import Counter

    rng = random.Random(21)
    spans = [folds.Span(" ".join(w), 0, 0, w) for w in ([f"token{rng.randrange(12)}" for _ in range(rng.randint(0, 9))] for _ in range(40))]
    n, df = len(spans), Counter(t for s in spans for t in set(s.tokens))
    vec = [{t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(s.tokens).items()} for s in spans]
    for i, (_, distance, _, _) in enumerate(folds.boundary_scores(spans), 1):
        sides = []
        for side in (range(max(0, i - 3), i), range(i, min(n, i + 3))):
            sides.append({t: sum(vec[k].get(t, 0) for k in side) / len(side) for t in {t for k in side for t in vec[k]}})
        norm = math.prod(math.sqrt(sum(x * x for x in v.values())) for v in sides)
        want = 1 - (sum(x * sides[1].get(t, 0) for t, x in sides[0].items()) / norm if norm else 0)
        assert abs(distance - want) < 1e-4


def test_sectioner_covers_long_documents():
    random.seed(3)
    words = [f"word{i}" for i in range(60)]
    text = " ".join(" ".join(random.choice(words) for _ in range(9)).capitalize() + "." for _ in range(400))
    s = folds.Sectioning()
    out = folds.Sectioner(text, s).sections()
    assert out[0][0] == 0 and all(len(t) <= s.most for *_, t, _ in out) and out[-1][1] == len(text)
    assert all(a[1] <= b[0] for a, b in zip(out, out[1:])) and all(text[a:b].strip() == t for a, b, t, _ in out)
    assert s.count_range(40_000) == (6, 14) and s.count_range(100) == (1, 2)
    assert folds.Sectioner("", s).sections() == [(0, 0, "", 0)]


def test_similar_pairs_and_greedy_match_brute_force(spark):
    random.seed(5)
    base = ["".join(random.choice("abcdef ") for _ in range(random.randint(20, 60))).strip() for _ in range(25)]
    rows = []
    for i in range(120):
        t = list(random.choice(base))
        for _ in range(random.randint(0, 4)):
            t[random.randrange(len(t))] = random.choice("abcdefgh")
        rows.append((i, "".join(t)))
    df = spark.createDataFrame(rows, "ord long, text string")
    norm = [folds.normalize_text(t) for _, t in rows]
    kept = similarity.first_wins(list(range(len(rows))), lambda i, k: SequenceMatcher(a=norm[i], b=norm[k]).ratio() > 0.9)
    got = similarity.greedy_keep(df, similarity.similar_pairs(df, 0.9, exact=True), "ord")
    assert sorted(r["ord"] for r in got.collect()) == kept


def test_similar_pairs_of_a_query_match_brute_force(spark):
    random.seed(7)
    texts = ["transformer", "transformers", "abcd", "abxcd", "graph network", "graph networks", "self attention", "self attentions", "注意力机制可以提高翻译质量并减少训练时间", "注意力机制可以提高翻译质量并减少训练时长"]
    names = [f"item{i}" for i in range(12)]
    for _ in range(12):
        w = [random.choice(names) for _ in range(16)]
        texts += [" ".join(["claim", *w]), " ".join(["claims", *w[:7], random.choice(names), *w[8:]])]
    norm = [folds.normalize_text(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
    for threshold in (0.86, 0.88, 0.9):
        want = {(i, k) for k in range(len(texts)) for i in range(k) if SequenceMatcher(a=norm[k], b=norm[i]).ratio() > threshold}
        got = {(r["a"], r["b"]) for r in similarity.similar_pairs(df, threshold).collect()}
        assert got == want and len(want) > 12


def test_common_subsequence_bounds_the_ratio():
    random.seed(6)
    for _ in range(300):
        a, b = ("".join(random.choice("abc") for _ in range(random.randint(0, 12))) for _ in range(2))
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        n = similarity.common_subsequence(a, b)
        assert n == rows[-1][-1] and 2 * n >= similarity.ratio(a, b) * (len(a) + len(b)) - 1e-9


def test_concepts(spark):
    one = spark.createDataFrame([("Ashish Vaswani",), ("Multi-Head Attention",), ("the",), ("LSTM",), ("Google Brain",), ("figure 3",), ("encoder",)], "n string")
    got = {r["n"]: r["ok"] for r in one.select("n", T.is_concept_name(F.col("n")).alias("ok")).collect()}
    assert got == {"Ashish Vaswani": False, "Multi-Head Attention": True, "the": False, "LSTM": True, "Google Brain": False, "figure 3": False, "encoder": False}
    rows = [("c1", "Self-Attention", [], "method", None, 0.95, ["s1"], "d", "s1"), ("c2", "self-attention", [], "method", "a way", 0.9, ["s2"], "d", "s2"), ("c3", "Attention", [], "method", None, 0.45, ["s3"], "d", "s3")]
    df = spark.createDataFrame(rows, "concept_id string, canonical_name string, aliases array<string>, concept_type string, definition string, importance double, source_section_ids array<string>, doc_id string, section_id string")
    [r] = concepts.canonical_concepts(df).collect()
    assert r["canonical_name"] == "Self-Attention" and "Attention" in r["aliases"] and r["definition"] == "a way" and r["source_section_ids"] == ["s1", "s2", "s3"]


def test_names_inside_longer_ones_match_the_loop(spark):
    names = ["attentional", "attention", "transformers", "transformer", "自注意力机制", "注意力", "力", "formers", "ai", "ai system", "a", "graph", "multi-head", "ulti-he", "", "zz"]
    leaders, want = [], []
    for i, name in enumerate(names):
        first = next((k for k in leaders if name in names[k]), None)
        leaders += [i] if first is None else []
        want.append((i, i if first is None else first))
    df = spark.createDataFrame(list(enumerate(names)), "pos long, norm string")
    assert sorted(tuple(r) for r in concepts._leaders(df, True).collect()) == want


def test_definition(spark):
    df = spark.createDataFrame([("BLEU", "We say BLEU is a metric for translation. More."), ("X+Y", "x+y: the sum"), ("Z", "nothing")], "n string, t string")
    assert [r[0] for r in df.select(concepts.definition_of(F.col("n"), F.col("t"))).collect()] == ["a metric for translation", "the sum", None]


def test_composed_answer(spark):
    df = spark.sql("select array(named_struct('statement', 'A.', 'evidence_ids', array('e1','e2')), named_struct('statement', 'B.', 'evidence_ids', array('e3'))) f, map('e1','A.','e2','C.','e3','D.') m")
    assert df.select(qa.composed_answer(F.col("f"), F.col("m"))).first()[0] == "A. C. B. D."


def test_question_duplicates_count_only_passed_ones(spark):
    rows = [(1, "Why does the encoder matter here?", False), (2, "Why does the encoder matter here?", True), (3, "Why does the encoder matter, here?", True), (4, "What is entirely different about it?", True)]
    got = {r["ord"]: r["duplicate"] for r in qa.keep_first_questions(spark.createDataFrame(rows, "ord long, question string, sound boolean")).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def test_provider_caches_and_reports_errors(spark):
    def call(name, system, payload):
        if payload["section"]["section_id"] == "bad":
            raise ValueError("no")
        return {"cards": []}

    s = spark.createDataFrame([("ok", "t", ["p"], "x"), ("bad", "t", ["p"], "y"), ("known", "t", ["p"], "z")], "section_id string, title string, section_path array<string>, text string")
    asked = provider.keyed(provider.card_requests(s))
    cache = asked.filter("id = 'known'").select("key", F.lit('{"cached": 1}').alias("reply"))
    got = {r["id"]: (r["reply"], r["error"]) for r in provider.replies(asked, call, cache, attempts=1).collect()}
    assert got["known"] == ('{"cached": 1}', None) and got["ok"] == ('{"cards": []}', None) and got["bad"] == (None, "ValueError: no")
    assert {r["error"] for r in provider.replies(asked).collect()} == {"disabled"}


def test_parse_cards_is_lenient(spark):
    text = "The encoder maps tokens to vectors because it attends to all of them. It is fast."
    reply = 'Sure: {"cards": [{"subject": "Encoder", "event_or_topic": "mapping tokens", "claim": "It maps.", "card_type": "odd", "source_spans": ["The encoder maps tokens to vectors because it attends to all."], "centrality": "2"}, {"subject": "it"}]} done'
    df = spark.createDataFrame([("s", "d", "t", ["t"], text, 0, reply), ("s2", "d", "t", ["t"], text, 0, "no json")], "section_id string, doc_id string, title string, section_path array<string>, text string, char_start long, reply string")
    [r] = cards.parse_cards(df).collect()
    assert r["card_type"] == "core_claim" and r["centrality"] == 1.0 and r["evidence"][0]["text"].startswith("The encoder maps tokens") and r["evidence"][0]["text"] in text


def test_deep_plan_replay(spark):
    text = "The Encoder maps tokens to vectors because it attends to all of them at once. The Decoder produces output tokens while it attends to the encoder output vectors."
    d = docs(spark, [("a.txt", text)])
    first = deep.run(d)
    assert first.plans.count() == 0 and first.cards.count() == 2
    ids = [r["card_id"] for r in first.cards.orderBy("pos").collect()]
    reply = '{"plans": [{"card_ids": ["%s"], "question": "Why does the Encoder attend to all tokens at once?", "difficulty": "hard"}, {"card_ids": ["nope"], "question": "x"}]}' % ids[0]
    again = deep.run(d, plan_replies=spark.createDataFrame([(0, reply)], "batch int, reply string"))
    [q] = again.dataset.collect()
    assert q["difficulty"] == "hard" and q["reference_context"][0]["text"].startswith("The Encoder") and again.rejected.count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_bytes(b"# x\r\ny")
    (tmp_path / "sub" / "b.txt").write_text("text")
    (tmp_path / ".hidden.txt").write_text("no")
    (tmp_path / "c.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "e.txt").write_text("")
    (tmp_path / "f.pdf").write_text("no")
    good, bad = files.read_documents(spark, str(tmp_path))
    assert {(r["file_name"], r["text"]) for r in good.collect()} == {("a.md", "# x\ny"), ("b.txt", "text")}
    assert [r["source_id"].rsplit("/", 1)[1] for r in bad.collect()] == ["c.txt"]
    files.write_jsonl(good.select("file_name", F.lit(None).cast("string").alias("n")), str(tmp_path / "out"))
    assert {r["file_name"] for r in files.read_jsonl(spark, str(tmp_path / "out"), "file_name string, n string").collect()} == {"a.md", "b.txt"}


def test_config(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("# c\ntarget_size: 5\nsectioning:\n  least: 300\n  tolerance: 0.5\nfile_types:\n  - .md\n  - '.txt'\n")
    s = config.load(str(f))
    assert s.target_size == 5 and s.sectioning.least == 300 and s.file_types == [".md", ".txt"]
    with pytest.raises(KeyError):
        config.overlaid(config.Settings(), {"unknown": 1})


def test_aliases_are_kept_and_the_last_concept_of_a_name_wins(spark):
    row = lambda i, name, aliases, imp: (f"c{i}", name, aliases, "term", None, imp, [f"s{i}"], "d", f"s{i}")
    schema = "concept_id string, canonical_name string, aliases array<string>, concept_type string, definition string, importance double, source_section_ids array<string>, doc_id string, section_id string"
    rows = [row(1, "GPU Encoder Layer", ["enc alias", "shared"], 0.9), row(2, "gpu encoder layer", [], 0.5), row(3, "GPU Decoder Network", ["shared"], 0.8), row(4, "Decoder", ["dec"], 0.4)]
    out = concepts.canonical_concepts(spark.createDataFrame(rows, schema))
    got = {r["canonical_name"]: r["aliases"] for r in out.collect()}
    assert got == {"GPU Encoder Layer": ["enc alias", "shared"], "GPU Decoder Network": ["Decoder", "dec", "shared"]}
    facts = spark.createDataFrame([("f1", "shared", ["GPU Encoder  layer", "gpu decoder network", "nothing"]), ("f2", "unknown", [])], "fact_id string, subject string, related_names array<string>")
    bound = concepts.bind_facts(facts, out).collect()
    ids = {r["canonical_name"]: r["concept_id"] for r in out.collect()}
    assert [(r["fact_id"], r["subject_concept_id"], r["related_concept_ids"]) for r in bound] == [("f1", ids["GPU Decoder Network"], [ids["GPU Encoder Layer"]])]


def test_knowledge_of_a_model_joins_the_heuristic_one(spark, tmp_path):
    from gleaner.plans import legacy

    text = "# GPU Attention Layer\nGPU Attention Layer is a part of the network that weighs all of its inputs by what they say.\nIt is short.\n"
    calls = []

    def call(prompt, system, payload):
        return {"concepts": ["GPU Attention Layer", {"concept": "GPU Encoder Stack", "aliases": "stack", "importance": "2"}, {"name": "it"}], "facts": [{"fact": "The GPU Encoder Stack reads what the GPU Attention Layer weighs.", "quote": "weighs all of its inputs", "subject_concept": "GPU Encoder Stack", "related_concepts": ["GPU Attention Layer"]}]}

    d = docs(spark, [("a.md", text)])
    folder = str(tmp_path / "cache")
    r = legacy.run(d, call=call, cache_folder=folder)
    names = {x["canonical_name"]: x for x in r.concepts.collect()}
    assert set(names) == {"GPU Attention Layer", "GPU Encoder Stack"} and "stack" in names["GPU Encoder Stack"]["aliases"] and names["GPU Encoder Stack"]["importance"] == 1.0
    facts = {x["subject"]: x for x in r.facts.collect()}
    assert facts["GPU Encoder Stack"]["related_concept_ids"] == [names["GPU Attention Layer"]["concept_id"]] and facts["GPU Attention Layer"]["confidence"] < 0.8
    assert r.validations.count() > 0
    # replies are kept: the second run asks nobody
    again = legacy.run(d, call=lambda *a: 1 / 0, cache_folder=folder)
    assert {x["canonical_name"] for x in again.concepts.collect()} == set(names) and not calls


def test_command_line(spark, tmp_path):
    import json

    from gleaner import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# GPU Encoder Layer\nGPU Encoder Layer is a part that reads all of the tokens before the decoder does so.\n")
    (tmp_path / "in" / "bad.txt").write_bytes(b"\xff\xfe")
    out = tmp_path / "out"
    counts = cli.main(["generate", "--input", str(tmp_path / "in"), "--output", str(out), "--target-size", "5", "--dry-run"], spark)
    assert counts["documents.json"] == 1 and counts["concepts.json"] == 1 and counts["facts.json"] == 1
    assert len([f for f in out.iterdir() if f.is_file() and f.name[0] != "."]) == 16 and json.loads((out / "concepts.json").read_text())[0]["canonical_name"] == "GPU Encoder Layer"
    assert json.loads((out / "errors.jsonl").read_text())["error_type"] == "UnicodeDecodeError"
    assert [json.loads(x)["id"] for x in (out / "dataset.final.jsonl").read_text().splitlines()] or counts["dataset.final.jsonl"] == 0
    counts = cli.main(["build-structure", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "two"), "--dry-run"], spark)
    assert set(counts) == {"documents.json", "document_structure.json"}
    counts = cli.main(["generate-deep", "--input", str(tmp_path / "in"), "--output", str(out), "--force", "--dry-run"], spark)
    assert len([f for f in out.iterdir() if f.is_file() and f.name[0] != "."]) == 11 and not (out / "concepts.json").exists()


def test_contained_passages(spark):
    rng = random.Random(22)
    texts = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 80)))) for i in range(60)] + [(60, None)]
    some = [(j, texts[rng.randrange(60)][1][rng.randrange(3) : rng.randrange(60)]) for j in range(40)] + [(40, None), (41, "zzz")]
    got = {(r["doc_id"], r["item_id"]) for r in similarity.contained(spark.createDataFrame(texts, "doc_id int, text string"), "text", spark.createDataFrame(some, "item_id int, passage string"), "passage").collect()}
    assert got == {(i, j) for i, t in texts for j, p in some if t is not None and p is not None and p in t}


def test_bounded_numbers(spark):
    got = spark.createDataFrame([("1.7",), ("-2",), ("0.3",), (None,), ("x",), ("NaN",)], "s string").select(T.bounded(F.col("s"), 0.5).alias("b")).collect()
    assert [r["b"] for r in got] == [1.0, 0.0, 0.3, 0.5, 0.5, 0.5]
