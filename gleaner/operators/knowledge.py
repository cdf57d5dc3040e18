"""Concepts, facts and relations from a model's replies, and their union with the heuristic ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import lexicons as L
from gleaner.functions import text as T
from gleaner.operators import concepts as K
from gleaner.operators import similarity
from gleaner.session import ship

SAME_FACT = 0.7


@dataclass
class Knowledge:
    """concepts and facts carry ``place``, their order in the section; evidence carries ``ord``."""

    concepts: DataFrame
    facts: DataFrame
    evidence: DataFrame


def _items(value: Column, name: str, inner: str) -> Column:
    """A list under name, or in an object there under items or inner."""
    lists = [F.try_variant_get(value, path, "array<variant>") for path in (f"$.{name}", f"$.{name}.items", f"$.{name}.{inner}")]
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])


def _field(item: Column, *names: str) -> Column:
    return T.strip(F.coalesce(*[F.try_variant_get(item, f"$.{n}", "string") for n in names], F.lit("")))


def _strings(item: Column, name: str) -> Column:
    found = F.coalesce(F.try_variant_get(item, f"$.{name}", "array<string>"), F.array(F.try_variant_get(item, f"$.{name}", "string")))
    return F.filter(F.transform(found, T.strip), lambda x: x.isNotNull() & (x != ""))


def _rows(replies: DataFrame, name: str, inner: str) -> DataFrame:
    keep = [c for c in ("section_id", "doc_id", "section_path", "title", "char_start", "text") if c in replies.columns]
    return replies.select(*keep, F.posexplode(_items(T.json_object(F.col("reply")), name, inner)).alias("place", "v"))


def parse_knowledge(replies: DataFrame) -> Knowledge:
    """Replies (section columns, reply) as concepts, facts and evidence; a reply that is no JSON object gives none.

    Lists may be objects that hold one; a concept may be its name alone and comes under name, concept or
    canonical_name; a fact's statement under statement, fact or text, its evidence under evidence, quote or
    evidence_text, or it is the statement.  Facts need a statement and a subject that can be a concept.  Relations between
    facts name them by text: the same one, else the most similar from SAME_FACT on.
    """
    own = F.when(F.schema_of_variant("v") == "STRING", F.try_variant_get("v", "$", "string"))
    rows = _rows(replies, "concepts", "concepts").withColumn("name", F.coalesce(T.strip(own), _field(F.col("v"), "name", "concept", "canonical_name")))
    rows = rows.filter(T.is_concept_name(F.col("name")))
    concepts = rows.select(
        T.stable_id("concept_raw", F.concat_ws(":", "section_id", "name")).alias("concept_id"), F.col("name").alias("canonical_name"), F.coalesce(_strings(F.col("v"), "aliases"), F.array().cast("array<string>")).alias("aliases"),
        F.coalesce(F.try_variant_get("v", "$.concept_type", "string"), T.concept_type(F.col("name"))).alias("concept_type"), F.try_variant_get("v", "$.definition", "string").alias("definition"),
        T.bounded(F.try_variant_get("v", "$.importance", "string"), 0.75).alias("importance"), F.array("section_id").alias("source_section_ids"), "doc_id", "section_id", "place",
    )
    rows = _rows(replies, "facts", "facts")
    v = F.col("v")
    rows = rows.withColumn("statement", _field(v, "statement", "fact", "text")).withColumn("said", _field(v, "evidence", "quote", "evidence_text", "statement", "fact", "text")).withColumn("subject", _field(v, "subject_concept"))
    rows = rows.filter((F.col("statement") != "") & (F.col("said") != "") & T.is_concept_name(F.col("subject")))
    at = F.instr("text", F.col("said")) - 1
    start = F.when(at >= 0, F.col("char_start") + at)
    facts = rows.select(
        T.stable_id("fact_raw", F.concat_ws(":", "section_id", "statement")).alias("fact_id"), F.coalesce(F.try_variant_get("v", "$.fact_type", "string"), T.fact_type(F.col("statement"))).alias("fact_type"), "subject", "statement",
        T.bounded(F.try_variant_get("v", "$.confidence", "string"), 0.8).alias("confidence"), T.bounded(F.try_variant_get("v", "$.importance", "string"), 0.75).alias("importance"),
        F.array(T.stable_id("ev", F.concat_ws(":", "section_id", "said"))).alias("evidence_ids"), F.coalesce(_strings(v, "related_concepts"), F.array().cast("array<string>")).alias("related_names"),
        "doc_id", "section_id", "section_path", F.col("title").alias("source_hint"), "said", start.alias("evidence_start"), (start + F.length("said")).alias("evidence_end"), "place",
    )
    evidence = facts.select(F.col("evidence_ids")[0].alias("evidence_id"), "doc_id", "section_id", "section_path", F.col("said").alias("text"), F.col("evidence_start").alias("char_start"), F.col("evidence_end").alias("char_end"), "source_hint", F.col("place").alias("ord"))
    last = K.Window.partitionBy("fact_id").orderBy(F.desc("place"))
    facts = facts.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r", "said")
    return Knowledge(concepts, _related(replies, facts), evidence)


def _related(replies: DataFrame, facts: DataFrame) -> DataFrame:
    """facts with ``depends_on_fact_ids`` and ``contrasts_with_fact_ids`` from the relations that replies state."""
    ship(facts.sparkSession)
    rows = _rows(replies, "fact_relations", "relations").select("section_id", "place", _field(F.col("v"), "relation_type").alias("kind"), F.explode(F.map_from_arrays(F.array(F.lit("source"), F.lit("target")), F.array(_field(F.col("v"), "source_fact"), _field(F.col("v"), "target_fact")))).alias("side", "said"))
    rows = rows.withColumn("said", T.normalize_text(F.col("said"))).filter("said <> ''")
    known = facts.select("section_id", "fact_id", T.normalize_text(F.col("statement")).alias("norm"), F.col("place").alias("at"))
    # a section's relations with its facts: both come from one reply
    met = rows.join(known, "section_id").withColumn("ratio", F.when(F.col("said") == F.col("norm"), 2.0).otherwise(similarity.ratio_column(F.col("said"), F.col("norm"))))
    best = met.filter(F.col("ratio") >= SAME_FACT).groupBy("section_id", "place", "kind", "side").agg(F.max_by("fact_id", F.struct("ratio", -F.col("at"))).alias("id"))
    pairs = best.groupBy("section_id", "place", "kind").agg(F.max(F.when(F.col("side") == "source", F.col("id"))).alias("fact_id"), F.max(F.when(F.col("side") == "target", F.col("id"))).alias("to")).filter("fact_id <> to")
    ids = lambda kinds: F.array_sort(F.collect_set(F.when(F.col("kind").isin(*kinds), F.col("to"))))
    found = pairs.groupBy("fact_id").agg(ids(L.DEPENDS_RELATIONS).alias("depends_on_fact_ids"), ids(L.CONTRAST_RELATIONS).alias("contrasts_with_fact_ids"))
    none = F.array().cast("array<string>")
    return facts.join(found, "fact_id", "left").withColumn("depends_on_fact_ids", F.coalesce("depends_on_fact_ids", none)).withColumn("contrasts_with_fact_ids", F.coalesce("contrasts_with_fact_ids", none))


def heuristic_knowledge(parts: DataFrame) -> Knowledge:
    found = K.section_concepts(parts)
    facts = K.section_facts(parts, found)
    return Knowledge(found.withColumnRenamed("pos", "place"), facts.withColumnRenamed("sent", "place"), K.fact_evidence(facts))


def merged(heuristic: Knowledge, model: Knowledge) -> Knowledge:
    """Both, by id: the model's rows win and stand where the heuristic ones stood; heuristic facts beside a model's must be worth it."""
    both = lambda a, b, key: K.upsert(a, b, key)
    facts = both(K.suppress_heuristic(heuristic.facts, model.facts), model.facts, "fact_id")
    evidence = both(heuristic.evidence.withColumnRenamed("ord", "place"), model.evidence.withColumnRenamed("ord", "place"), "evidence_id").withColumnRenamed("place", "ord")
    return Knowledge(both(heuristic.concepts, model.concepts, "concept_id"), facts, evidence)
