"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Metrics are built-in column expressions over the whole text; ``THRESHOLDS`` says
which range of each metric a clean document lies in, and from how many words on
the rule speaks.  No shuffle, no Python: the operator is a narrow projection.

Null and empty texts have no words, so they have zero counts and fail the base
rule; ``kept`` is never null.  Extra columns pass through ``add_quality`` unless
their name is one of the operator's own (they are then replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import SPACES, SPACES_RE, ascii_lower

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of the languages at hand; a parameter of ``add_quality``.
STOP_WORDS = tuple(
    sorted(
        set(
            "the of and to in is that it was for on are as with his they at be this from have or by one had not but "
            "le la les de des et un une du que qui en dans pour pas sur au avec est par "
            "der die das und ist nicht ein eine mit den von zu im auf dem sich als auch es an "
            "el los las y por con para del se no su lo como más pero sus".split()
        )
    )
)


@dataclass(frozen=True)
class Rule:
    """A clean document has low <= metric <= high once it has min_words words."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 20


THRESHOLDS = (
    Rule("word_length", "mean_word_length", low=2.5, high=12.0),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("letters", "letter_word_ratio", low=0.6),
    Rule("stop_words", "stop_word_ratio", low=0.02, min_words=50),
    Rule("line_ends", "ended_line_ratio", low=0.5),
    Rule("same_lines", "dup_line_ratio", high=0.35),
    Rule("ellipses", "ellipsis_line_ratio", high=0.3),
)


def compile_rules(rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """The comma-joined names of the rules that a row breaks, as one column expression."""

    def broken(rule: Rule) -> Column:
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (F.col(rule.metric) < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (F.col(rule.metric) > F.lit(rule.high))
        return F.when((F.col("n_words") >= rule.min_words) & bad, F.lit(rule.name))

    return F.concat_ws(",", *[broken(r) for r in rules])


def repeated_words(words: str, n_words: str, window: int = WINDOW) -> list[tuple[str, Column]]:
    """Steps (name, column) whose last one counts the words lying in a window of the text that occurs twice or more.

    Windows are hashed, and only texts with an equal pair sort them; the sorted
    neighbours give the starts, and starts less than a window apart overlap.
    """
    hashes = F.expr(f"if({n_words} < {window}, cast(array() as array<bigint>), transform(sequence(1, greatest({n_words} - {window - 1}, 1)), i -> xxhash64(slice({words}, i, {window}))))")
    ranked = F.expr("if(size(_hashes) = size(array_distinct(_hashes)), cast(array() as array<struct<h:bigint,i:int>>), sort_array(transform(_hashes, (h, i) -> named_struct('h', h, 'i', i))))")
    starts = F.expr("sort_array(filter(transform(_ranked, (s, j) -> if(coalesce(s.h = get(_ranked, j - 1).h, false) or coalesce(s.h = get(_ranked, j + 1).h, false), s.i, null)), i -> i is not null))")
    covered = F.expr(f"aggregate(transform(_starts, (s, j) -> least({window}, coalesce(get(_starts, j + 1) - s, {window}))), 0L, (a, x) -> a + x)")
    return [("_hashes", hashes), ("_ranked", ranked), ("_starts", starts), ("n_repeat_words", covered)]


def add_quality(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = THRESHOLDS, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """df with the counts, the ratios, ``broken_rules``, ``base_failed`` and ``kept``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    words_per = lambda name: share(name, "n_words")
    lines_per = lambda name: share(name, "_n_lines")
    bare = F.translate(ascii_lower(body), ".,;:!?\"'()" + SPACES[1:], " " * (10 + len(SPACES) - 1))
    steps = [
        ("_words", F.array_remove(F.split(body, SPACES_RE, -1), "")),
        ("_lines", lines),
        ("n_words", F.size("_words").cast("long")),
        ("word_chars", F.length(F.translate(body, SPACES, "")).cast("long")),
        ("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long")),
        ("_n_lines", F.size("_lines").cast("long")),
        ("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")),
        ("_size", F.size("_words")),
        *repeated_words("_words", "_size"),
        ("_stops", F.size(F.filter(F.split(bare, " ", -1), lambda w: w.isin(*stop_words))).cast("long")),
        ("_lettered", F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long")),
        ("_ended", F.size(F.filter("_lines", lambda x: x.rlike(r"""[.!?:;"')»”…][\x20\x09-\x0D]*$"""))).cast("long")),
        ("_dotted", F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long")),
        ("mean_word_length", words_per("word_chars")),
        ("symbol_ratio", words_per("n_symbols")),
        ("letter_word_ratio", words_per("_lettered")),
        ("stop_word_ratio", words_per("_stops")),
        ("ended_line_ratio", lines_per("_ended")),
        ("dup_line_ratio", lines_per("n_dup_lines")),
        ("ellipsis_line_ratio", lines_per("_dotted")),
        ("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)),
        ("broken_rules", compile_rules(rules)),
        ("kept", ~F.col("base_failed") & (F.col("broken_rules") == "")),
    ]
    for name, column in steps:
        df = df.withColumn(name, column)
    return df.drop("_words", "_lines", "_n_lines", "_size", "_hashes", "_ranked", "_starts", "_stops", "_lettered", "_ended", "_dotted")


#: The same in DuckDB; thresholds and stop words come from the tables above.
def oracle(rules: tuple[Rule, ...] = THRESHOLDS, stop_words: tuple[str, ...] = STOP_WORDS) -> str:
    metric = {
        "mean_word_length": "word_chars / greatest(n_words, 1)",
        "symbol_ratio": "n_symbols / greatest(n_words, 1)",
        "letter_word_ratio": "lettered / greatest(n_words, 1)",
        "stop_word_ratio": "stops / greatest(n_words, 1)",
        "ended_line_ratio": "ended / greatest(n_lines, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
        "ellipsis_line_ratio": "dotted / greatest(n_lines, 1)",
    }
    tests = []
    for r in rules:
        sides = [f"{metric[r.metric]} < {r.low}"] * (r.low is not None) + [f"{metric[r.metric]} > {r.high}"] * (r.high is not None)
        tests.append(f"CASE WHEN n_words >= {r.min_words} AND ({' OR '.join(sides)}) THEN '{r.name}' END")
    quoted = ", ".join(f"'{w}'" for w in stop_words)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS lines FROM d),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(string_split(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?"''()' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz               '), ' '), lambda x: x IN ({quoted}))) AS stops,
  len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS lettered,
  len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:;"'')»”…][\x20\x09-\x0D]*$'))) AS ended,
  len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS dotted
  FROM w LEFT JOIN rep USING (doc_id)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, concat_ws(',', {', '.join(tests)}) AS broken_rules FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken_rules = '' AS kept, broken_rules FROM g
"""


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken_rules")
