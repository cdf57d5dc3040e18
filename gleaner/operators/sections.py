"""Documents to sections: by headings (windows over lines) or by meaning (a fold by document)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions import text as T
from gleaner.operators import folds
from gleaner.session import ship

SECTION = "section_id string, doc_id string, title string, level int, section_path array<string>, text string, char_start long, char_end long, summary string, keywords array<string>, ordinal int, sentence_count int"


def few(batches, most: int = 64):
    """Batches of a few rows each: what Python makes of texts at a time is bounded, however many rows Spark hands over at once."""
    for b in batches:
        for s in range(0, b.num_rows, most):
            yield b.slice(s, most)


def documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table adapter: rows as documents named after their key."""
    name = F.col(key).cast("string")
    return df.select(T.stable_id("doc", name).alias("doc_id"), F.concat(name, F.lit(".txt")).alias("file_path"), F.concat(name, F.lit(".txt")).alias("file_name"), F.lit(".txt").alias("file_type"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, line): the lines of every text, in order from 0."""
    return df.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n", -1)).alias("n", "line"))


def drop_repeated_lines(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """lines() without page numbers and repeated running heads."""
    flat = rows.withColumn("flat", T.normalize_line(F.col("line")))
    counted = flat.withColumn("times", F.count("*").over(Window.partitionBy(key, "flat"))).withColumn("all_lines", F.count("*").over(Window.partitionBy(key)))
    often = F.greatest(F.lit(3), F.floor(F.col("all_lines") / 80))
    running = (F.col("flat") != "") & (F.length("flat") <= 90) & (F.col("times") >= often) & ~T.is_heading(F.col("flat"))
    return counted.filter(~T.is_page_number(F.col("flat")) & ~running).select(key, "n", "line")


def _finish(df: DataFrame) -> DataFrame:
    """Identity, summary and keywords of heading sections."""
    ident = F.concat_ws(":", "doc_id", F.col("char_start").cast("string"), F.col("char_end").cast("string"), F.coalesce("title", F.lit("root")))
    words = F.udf(lambda t: folds.keywords(t or ""), "array<string>", useArrow=True)
    ship(df.sparkSession)
    return df.select(
        T.stable_id("sec", ident).alias("section_id"), "doc_id", "title", "level", "section_path", "text", "char_start", "char_end",
        T.strip(F.substring("text", 1, 200)).alias("summary"), words("text").alias("keywords"), F.row_number().over(Window.partitionBy("doc_id").orderBy("char_start")).alias("ordinal"), F.lit(0).alias("sentence_count"),
    )


def _bodies(heads: DataFrame, docs: DataFrame) -> DataFrame:
    """heads (doc_id, n, level, title, section_path, body_at, next_at) to sections; documents without any get a root section."""
    found = heads.join(docs.select("doc_id", F.col("text").alias("_all")), "doc_id")
    end = F.coalesce(F.col("next_at"), F.length("_all"))
    found = found.withColumn("text", T.strip(F.col("_all").substr((F.col("body_at") + 1).cast("int"), (end - F.col("body_at")).cast("int")))).filter("text <> ''")
    found = found.select("doc_id", "title", "level", "section_path", "text", F.col("body_at").cast("long").alias("char_start"), end.cast("long").alias("char_end"))
    root = docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(
        "doc_id", F.lit(None).cast("string").alias("title"), F.lit(None).cast("int").alias("level"), F.array().cast("array<string>").alias("section_path"), "text", F.lit(0).cast("long").alias("char_start"), F.length("text").cast("long").alias("char_end")
    )
    return _finish(found.unionByName(root))


def _placed(docs: DataFrame) -> tuple[DataFrame, Window]:
    by_line = Window.partitionBy("doc_id").orderBy("n")
    rows = lines(docs).withColumn("at", F.coalesce(F.sum(F.length("line") + 1).over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows, by_line


def markdown_sections(docs: DataFrame) -> DataFrame:
    """A section for the body under each # heading; its path holds the headings above it."""
    rows, by_line = _placed(docs)
    mark = F.regexp_extract(T.strip(F.col("line")), r"^(#{1,6})\s+(.*)$", 1)
    rows = rows.withColumn("level", F.when(F.length(mark) > 0, F.length(mark))).withColumn("title", T.strip(F.regexp_extract(T.strip(F.col("line")), r"^(#{1,6})\s+(.*)$", 2))).filter("level is not null")
    for k in range(1, 7):
        # the last heading of level k, forgotten as soon as one of a smaller level follows it
        last = F.last(F.when(F.col("level") == k, F.struct("n", "title")), ignorenulls=True).over(by_line)
        higher = F.last(F.when(F.col("level") < k, F.col("n")), ignorenulls=True).over(by_line) if k > 1 else F.lit(None).cast("int")
        rows = rows.withColumn(f"_p{k}", last).withColumn(f"_h{k}", higher)
    open_ = lambda k: F.when((F.col("level") >= k) & (F.col(f"_h{k}").isNull() | (F.col(f"_h{k}") < F.col(f"_p{k}.n"))), F.col(f"_p{k}.title"))
    rows = rows.withColumn("section_path", F.array_compact(F.array(*[open_(k) for k in range(1, 7)])))
    heads = rows.select("doc_id", "n", "level", "title", "section_path", F.least(F.col("at") + F.length("line") + 1, F.lit(2**31 - 2)).alias("body_at"), F.lead("at").over(by_line).alias("next_at"))
    return _bodies(heads, docs)


def is_text_heading(line: Column, before: Column, after: Column) -> Column:
    """A short line after a blank one that is followed by a blank one, numbered, in capitals or in title case."""
    x = T.strip(line)
    blank = lambda c: F.coalesce(T.strip(c) == "", F.lit(True))
    # title case: every letter after a non-letter is upper case, all others lower case
    title = ~x.rlike(r"(?U)(?:^|\P{L})\p{Ll}") & ~x.rlike(r"(?U)\p{L}\p{Lu}")
    words = F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    return (x != "") & (F.length(x) <= 80) & blank(before) & (blank(after) | x.rlike(r"^\d+(\.\d+)*[.)]?\s+\S+") | (T.is_upper(x) & x.rlike(r"\p{L}")) | (title & (words <= 10)))


def text_sections(docs: DataFrame) -> DataFrame:
    """A section for the body under each line that looks like a heading; text before the first one belongs to none."""
    rows, by_line = _placed(docs)
    rows = rows.withColumn("is_head", is_text_heading(F.col("line"), F.lag("line").over(by_line), F.lead("line").over(by_line))).filter("is_head")
    title = T.strip(F.col("line"))
    heads = rows.select("doc_id", "n", F.lit(1).alias("level"), title.alias("title"), F.array(title).alias("section_path"), (F.col("at") + F.length("line") + 1).alias("body_at"), F.lead("at").over(by_line).alias("next_at"))
    return _bodies(heads, docs)


def heading_sections(docs: DataFrame) -> DataFrame:
    """Markdown files by their marks, all others by how their lines look."""
    is_md = F.col("file_type").isin(".md", ".markdown")
    return markdown_sections(docs.filter(is_md)).unionByName(text_sections(docs.filter(~is_md)))


def semantic_sections(docs: DataFrame, settings: folds.Sectioning | None = None, clean: bool = True) -> DataFrame:
    """Sections by adaptive boundaries; texts are cleaned first unless told otherwise."""
    settings = settings or folds.Sectioning()

    def run(batches):
        import pyarrow as pa

        for b in few(batches):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, (a, z, t, n) in enumerate(folds.Sectioner(text or "", settings).sections(), 1):
                    rows.append({"section_id": folds.stable_id("semsec", f"{doc}:{a}:{z}:{i}"), "doc_id": doc, "title": None, "level": 1, "section_path": None, "text": t, "char_start": a, "char_end": z, "summary": t[:200].strip(), "keywords": folds.keywords(t), "ordinal": i, "sentence_count": n})
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow_section())

    ship(docs.sparkSession)
    found = (cleaned(docs) if clean else docs).select("doc_id", "text").mapInArrow(run, SECTION)
    return found.withColumn("title", T.section_title(F.col("text"), F.col("ordinal"))).withColumn("section_path", F.array("title"))


def _arrow_section():
    import pyarrow as pa

    s, i = pa.string(), pa.int32()
    return pa.schema([("section_id", s), ("doc_id", s), ("title", s), ("level", i), ("section_path", pa.list_(s)), ("text", s), ("char_start", pa.int64()), ("char_end", pa.int64()), ("summary", s), ("keywords", pa.list_(s)), ("ordinal", i), ("sentence_count", i)])


def cleaned(docs: DataFrame) -> DataFrame:
    """docs with the text of their pages as paragraphs, from the abstract up to the references."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in few(batches):
            yield b.set_column(at, "text", pa.array([folds.pages_to_paragraphs(t or "") for t in b.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema).withColumn("text", T.strip(T.trim_matter(F.col("text"))))


def units(sections: DataFrame, most: int = 9000, prefix: str = "deep_sec", clean=T.clean_unit) -> DataFrame:
    """Sections cut at paragraphs to ``most`` characters, cleaned; each unit is a section of its own (unit_ord from 1).

    Parts of a section are numbered in its title, and known by where they begin.
    """

    ship(sections.sparkSession)
    rows = sections.select("section_id", "doc_id", "title", "level", "section_path", "text", "char_start", "ordinal")

    def run(batches):
        import pyarrow as pa

        for b in few(batches):
            packed = [(k, i, c, x, len(t or "") > most) for k, t in enumerate(b.column(5).to_pylist()) for i, (c, x) in enumerate(folds.pack_paragraphs(t or "", most), 1)]
            k, i, c, x, split = zip(*packed)
            out = b.take(pa.array(k, pa.int32())).set_column(5, "text", pa.array(x, pa.string()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(i, pa.int32()), pa.array(c, pa.int32()), pa.array(split, pa.bool_())], [*out.schema.names, "unit_ord", "_cursor", "_split"])

    def words(batches):
        import pyarrow as pa

        for b in few(batches):
            yield b.append_column("keywords", pa.array([folds.keywords(t or "") for t in b.column(5).to_pylist()], pa.list_(pa.string())))

    with_units = StructType([*rows.schema.fields, *StructType.fromDDL("unit_ord int, _cursor int, _split boolean").fields])
    rows = rows.mapInArrow(run, with_units).withColumn("text", clean(F.col("text")))
    rows = rows.mapInArrow(words, StructType([*with_units.fields, *StructType.fromDDL("keywords array<string>").fields]))
    start = F.col("char_start") + F.col("_cursor")
    ident = F.concat_ws(":", "section_id", F.col("unit_ord").cast("string"), start.cast("string"))
    named = F.concat(F.coalesce(F.when(F.col("title") != "", F.col("title")), F.try_element_at("section_path", F.lit(-1)), F.lit("section")), F.lit(" ["), F.col("unit_ord").cast("string"), F.lit("]"))
    return rows.select(
        F.when(F.col("_split"), T.stable_id(prefix, ident)).otherwise(F.col("section_id")).alias("section_id"), "doc_id", F.when(F.col("_split"), named).otherwise(F.col("title")).alias("title"), "level", "section_path",
        "text", start.alias("char_start"), (start + F.length("text")).alias("char_end"), T.strip(F.substring("text", 1, 200)).alias("summary"), "keywords", "ordinal", "unit_ord",
    )
