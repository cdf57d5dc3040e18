"""Content-defined line chunks: repeated multi-line passages are found whatever lines surround them.

The lines of a text are hashed; a rolling hash over two successive line hashes
says where a chunk ends, unless it said so of the line before, so boundaries depend
on nearby content only, an inserted line shifts none but its own chunk, and a chunk
has two lines at least (what a text ends with may be one line).  Chunks of two or more
lines that occur more than once in the corpus keep their first place (smallest doc_id,
then earliest); at later places they are removed after their bytes were compared.
A passage seldom begins or ends with a chunk, so a removed chunk grows line by line
over the chunks beside it, as far as these lines equal those beside the first place.
Every removed line thus stands in a passage of two or more lines that is kept at an
earlier place.

Native: built-in expressions, joins and aggregates only.  Sixty-four-bit chunk
hashes are counted first (numbers only, combined on the map side), so text moves
only for chunks whose hash is repeated.  A chunk that a third of all rows share
is one row for each map task in the aggregate and is split in the join.

Null and empty texts have no chunks and come back unchanged (a null stays null).
Rows are told apart by doc_id (null is an id like any other) and a 64-bit hash of the
text: rows that agree in both are one document and come back alike; different texts
under one id are different documents.  Lines without a word end no chunk by themselves
and count as lines.  Other columns of the input are kept, whatever their names; those
with the name of a result (n_lines, n_chunks, n_removed_chunks, n_removed_lines) are
replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A chunk ends where the rolling hash is 0 modulo this and was not at the line before: with 2, at every fourth line on average.
MODULUS = 2
#: Line hashes are the first 32 bits of MD5; the rolling hash is (previous * MULTIPLIER + this) modulo 2**32.
MULTIPLIER = 31

RESULTS = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")


def chunked(rows: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """rows (with a column ``text``) with ``lines`` and ``chunks``, an array of structs.

    first, n: first line and number of lines of every chunk of two or more; p, q: lines of the chunks before and after it.
    """
    before = "get(ends, j - 1)"
    steps = [
        ("lines", F.when(F.length("text") > 0, F.split("text", "\n", -1))),
        ("h", F.expr("transform(lines, x -> cast(conv(substring(md5(x), 1, 8), 16, 10) as bigint))")),
        ("says", F.expr(f"transform(h, (x, i) -> i > 0 and ((get(h, i - 1) * {MULTIPLIER} + x) % 4294967296) % {modulus} = 0)")),
        ("ends", F.expr("filter(sequence(0, size(h) - 1), i -> i = size(h) - 1 or (get(says, i) and not get(says, i - 1)))")),
        ("ends", F.expr("if(lines is null, cast(array() as array<int>), ends)")),
        ("chunks", F.expr(f"transform(ends, (e, j) -> named_struct('first', coalesce({before} + 1, 0), 'n', e - coalesce({before}, -1), 'p', coalesce({before} - coalesce(get(ends, j - 2), -1), 0), 'q', coalesce(get(ends, j + 1) - e, 0)))")),
        ("chunks", F.expr("filter(chunks, c -> c.n >= 2)")),
    ]
    for name, column in steps:
        rows = rows.withColumn(name, column)
    return rows.drop("h", "says", "ends")


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, row): what a row is known by, and its other columns; no row where there are none."""
    body = F.col(f"`{text}`")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    # without others both uses of the rows need the same columns, so that text is shuffled once
    return docs.select(F.struct(F.col(f"`{key}`").alias("k"), F.xxhash64(body).alias("h")).alias("id"), body.alias("text"), *([F.struct(*others).alias("row")] if others else []))


def _lines(first: str, n: str):
    return F.slice("lines", F.expr(first) + 1, F.expr(n))


def repeated_passages(rows: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """(id, first, n) of every passage to remove, one for each repeated chunk; rows: (id, text)."""
    # explode_outer: explode would make the optimizer copy the whole chunk expression into a filter below it
    places = chunked(rows, modulus).select("id", "lines", F.explode_outer("chunks").alias("c")).filter("c is not null")
    places = places.select("id", "c", F.xxhash64(F.array_join(_lines("c.first", "c.n"), "\n")).alias("hash"))
    often = places.groupBy("hash").agg(F.count("*").alias("times")).filter("times > 1").select("hash")
    marked = places.join(often, "hash", "left_semi").groupBy(F.col("id").alias("of")).agg(F.collect_set(F.struct("c", "hash")).alias("marks"))
    # a left join on purpose: the exchange of rows is the one that dedup_lines uses again
    whole = rows.join(marked, F.col("id") == F.col("of"), "left").select("id", F.split("text", "\n", -1).alias("lines"), F.explode_outer("marks").alias("m")).filter("m is not null")
    found = whole.select("id", "m.hash", "m.c.first", "m.c.n", F.array_join(_lines("m.c.first", "m.c.n"), "\n").alias("body"), _lines("m.c.first - m.c.p", "m.c.p").alias("above"), _lines("m.c.first + m.c.n", "m.c.q").alias("below"))
    place = F.struct("id", "first")
    least = found.groupBy("hash", "body").agg(F.min(place).alias("keep"), F.min_by(F.struct("above", "below"), place).alias("beside"), F.count("*").alias("times")).filter("times > 1").drop("times")
    later = found.join(least, ["hash", "body"]).filter((F.col("id") != F.col("keep.id")) | (F.col("first") != F.col("keep.first")))
    alike = lambda side, sign: F.expr(
        f"if(least(size({side}), size(beside.{side})) = 0, 0, coalesce(nullif(array_position(transform(sequence(1, least(size({side}), size(beside.{side}))), k -> element_at({side}, {sign}k) = element_at(beside.{side}, {sign}k)), false), 0) - 1, least(size({side}), size(beside.{side}))))"
    )
    later = later.select("id", "first", "n", alike("above", "-").cast("int").alias("up"), alike("below", "").cast("int").alias("down"))
    return later.select("id", (F.col("first") - F.col("up")).alias("first"), (F.col("n") + F.col("up") + F.col("down")).alias("n"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = MODULUS) -> DataFrame:
    """docs with later copies of repeated passages removed from the text, and ``n_lines``, ``n_chunks``, ``n_removed_chunks``, ``n_removed_lines``.

    A document that loses every line keeps its row with an empty text.
    """
    rows = identified(docs, key, text)
    gone = repeated_passages(rows.select("id", "text"), modulus).groupBy(F.col("id").alias("of")).agg(F.collect_list(F.struct("first", "n")).alias("gone"))
    out = chunked(rows.join(gone, F.col("id") == F.col("of"), "left"), modulus)
    steps = [
        ("n_lines", F.greatest(F.size("lines"), F.lit(0)).cast("long")),
        ("n_chunks", F.size("chunks").cast("long")),
        ("n_removed_chunks", F.greatest(F.size("gone"), F.lit(0)).cast("long")),
        ("out", F.expr("array_distinct(flatten(transform(gone, g -> sequence(g.first, g.first + g.n - 1))))")),
        ("n_removed_lines", F.greatest(F.size("out"), F.lit(0)).cast("long")),
        ("text", F.expr("if(gone is null, text, array_join(transform(array_except(sequence(0, size(lines) - 1), out), i -> get(lines, i)), '\\n'))")),
    ]
    for name, column in steps:
        out = out.withColumn(name, column)
    place = {text: F.col("text"), key: F.col("id.k")}
    kept = [(place[c] if c in place else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in RESULTS or c == text]
    return out.select(*kept, *[c for c in RESULTS if c != text])


def oracle(modulus: int = MODULUS) -> str:
    alike = lambda a, b, at, bt: f"coalesce(list_min(list_filter(range(1, least(len({a}), len({b})) + 1), lambda k: {a}[{at}] <> {b}[{bt}])) - 1, least(len({a}), len({b})))"
    return f"""
WITH l AS (SELECT doc_id, text, CASE WHEN length(text) > 0 THEN string_split(text, chr(10)) END AS lines FROM documents),
h AS (SELECT doc_id, i, lines[i] AS line, CAST('0x' || substr(md5(lines[i]), 1, 8) AS BIGINT) AS h, len(lines) AS n FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l)),
s AS (SELECT *, coalesce((lag(h) OVER w * {MULTIPLIER} + h) % 4294967296 % {modulus} = 0, false) AS says FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, i = n OR (says AND NOT lag(says) OVER (PARTITION BY doc_id ORDER BY i)) AS ends FROM s),
c AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM e),
a AS (SELECT doc_id, c, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body, list(line ORDER BY i) AS own FROM c GROUP BY doc_id, c),
b AS (SELECT *, coalesce(lag(own) OVER w, []) AS above, coalesce(lead(own) OVER w, []) AS below FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY c)),
k AS (SELECT *, row_number() OVER w > 1 AS gone, first_value(above) OVER w AS up, first_value(below) OVER w AS down FROM b WHERE n >= 2 WINDOW w AS (PARTITION BY body ORDER BY doc_id, first)),
g AS (SELECT doc_id, first - {alike('above', 'up', 'len(above) + 1 - k', 'len(up) + 1 - k')} AS x, first + n + {alike('below', 'down', 'k', 'k')} AS y FROM k WHERE gone),
o AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(x, y)) AS i FROM g)),
kept AS (SELECT h.doc_id, string_agg(h.line, chr(10) ORDER BY h.i) AS body FROM h LEFT JOIN o ON h.doc_id = o.doc_id AND h.i = o.i WHERE o.i IS NULL GROUP BY h.doc_id),
n AS (SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (WHERE gone) AS n_removed_chunks FROM k GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n_removed_lines FROM o GROUP BY doc_id)
SELECT l.doc_id, CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks, CAST(coalesce(n_removed_chunks, 0) AS BIGINT) AS n_removed_chunks,
  CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines, sha256(coalesce(kept.body, '')) AS kept_sha256
FROM l LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
