"""Text rules as Spark columns: built-in expressions only, no Python at run time (lambdas over arrays are interpreted by the JVM).

Every function takes and gives columns; null text gives null unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import lexicons as L

CJK = r"一-鿿"
#: Python's white space: Unicode's and the separators 1C to 1F.
WS = r"(?U)[\s\x1c-\x1f]"
EDGE = "[ ，,。.;；]+"


def _any(c: Column, terms: Sequence[str]) -> Column:
    """Whether one of the terms is a substring."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(c, F.lit(t))
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used: branches of a case don't share expressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cases(pairs: Sequence[tuple[Column, str]], default: str) -> Column:
    out = None
    for cond, label in pairs:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def _mapped(c: Column, table: dict[str, str], default: str) -> Column:
    return _cases([(c == k, v) for k, v in table.items()], default)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return strip(F.regexp_replace(c, WS + "+", " "))


def trim_edges(c: Column, left: bool = True) -> Column:
    """Without spaces and separating punctuation at the ends (or the right end only)."""
    return F.regexp_replace(c, (f"^{EDGE}|" if left else "") + f"{EDGE}$", "")


def normalize_text(c: Column) -> Column:
    """Collapsed, lower case, then everything but word characters, white space and hyphens deleted."""
    return F.regexp_replace(F.lower(collapse(c)), r"(?U)[^\p{L}\p{N}_\s-]", "")


def contains_cjk(c: Column) -> Column:
    return c.rlike(f"[{CJK}]")


def stable_id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(c), 1, 10))


def sentences(c: Column) -> Column:
    """Pieces that end in a terminator followed by white space, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, rf"(?<=[。！？!?.]){WS}+"), strip), lambda s: s != "")


def deep_tokens(c: Column) -> Column:
    return F.regexp_extract_all(normalize_text(c), F.lit(rf"[A-Za-z][A-Za-z0-9_\-]{{2,}}|[{CJK}]{{2,}}"), F.lit(0))


def section_tokens(c: Column) -> Column:
    """Lower-case tokens; longer CJK runs add their pairs of characters; without stop words."""
    raw = F.regexp_extract_all(normalize_text(c), F.lit(rf"[a-z][a-z0-9_\-]{{2,}}|[{CJK}]{{2,}}"), F.lit(0))

    def more(t: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: t.substr(i, F.lit(2)))
        return F.when(contains_cjk(t) & (F.length(t) > 2), F.concat(F.array(t), pairs)).otherwise(F.array(t))

    return F.filter(F.flatten(F.transform(raw, more)), lambda t: ~t.isin(*L.SECTION_STOPWORDS))


def keyword_tokens(c: Column) -> Column:
    """Normalised candidate keywords with repetitions, without stop words."""
    raw = F.regexp_extract_all(c, F.lit(rf"[A-Za-z][A-Za-z0-9_\-]{{2,}}|[{CJK}]{{2,}}"), F.lit(0))
    return F.filter(F.transform(raw, F.lower), lambda t: (t != "") & ~t.isin(*L.KEYWORD_STOPWORDS))


def clean_short(c: Column, most: int = 120) -> Column:
    """In higher-order functions wrap this in a lambda: a second parameter would be taken for the index."""
    return trim_edges(F.substring(collapse(c), 1, most))


def clean_question(c: Column) -> Column:
    return let(collapse(c), lambda text: F.when((text != "") & ~text.rlike("[？?]$"), F.concat(text, F.lit("？"))).otherwise(text))


def shared(a: Column, b: Column) -> Column:
    """The share of a's tokens that b has (0 if either has none), of arrays of distinct ones."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(0.0))


def token_overlap(left: Column, right: Column) -> Column:
    """The share of left's distinct tokens that right has (0 if either has none)."""
    return let(F.array_distinct(deep_tokens(left)), lambda a: let(F.array_distinct(deep_tokens(right)), lambda b: shared(a, b)))


def half_in(tokens: Column, text: Column) -> Column:
    """Half of the tokens (one at least) are substrings of text."""
    hits = F.size(F.filter(tokens, lambda t: F.contains(text, t)))
    return (F.size(tokens) > 0) & (hits >= F.greatest(F.lit(1), F.floor(F.size(tokens) / 2)))


def loose_overlap(topic: Column, text: Column) -> Column:
    """Half of the topic's tokens (one at least) are substrings of text."""
    return let(deep_tokens(topic), lambda tokens: let(text, lambda t: half_in(tokens, t)))


def is_upper(c: Column) -> Column:
    """There are cased letters, and all of them are upper case."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def is_heading(c: Column) -> Column:
    """A line that stands alone as a heading: numbered, marked, or in capitals."""
    words = F.size(F.filter(F.split(c, WS + "+"), lambda w: w != ""))
    return (c != "") & (F.length(c) <= 120) & (c.rlike(r"^(?:\d+(?:\.\d+)*|[A-Z])[.)]\s+\S+") | c.startswith("#") | (is_upper(c) & (words <= 12) & c.rlike(r"\p{L}")))


def normalize_line(c: Column) -> Column:
    return collapse(F.translate(c, "­", ""))


def is_page_number(c: Column) -> Column:
    return F.lower(c).rlike(r"^(?:page\s*)?\d{1,4}$") | c.rlike(r"^-\s*\d{1,4}\s*-$")


def is_noise_line(c: Column) -> Column:
    return F.contains(c, F.lit("@")) | _any(F.lower(c), L.NOISE_PHRASES)


#: Where Python's splitlines ends a line.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def unwrap_lines(c: Column) -> Column:
    """Hard-wrapped lines as one line for each paragraph; headings, list items and short lines keep their breaks.

    Words that a hyphen cuts at the end of a line are whole again.
    """
    whole = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"(?U)(\w)-\n(\w)", "$1$2")

    def joined(block: Column) -> Column:
        lines = F.filter(F.transform(F.split(block, LINE_ENDS), lambda x: strip(x)), lambda x: x != "")
        keeps = lambda done, x: x.rlike(r"(?U)^(?:#{1,6}\s+|\d+[.)]\s+)") | (is_upper(x) & (F.length(x) <= 80)) | (F.greatest(F.length(done), F.length(x)) < 40)
        return F.aggregate(lines, F.lit(""), lambda done, x: F.when(done == "", x).otherwise(F.concat(done, F.when(keeps(done, x), "\n").otherwise(" "), x)))

    blocks = F.split(whole, rf"\n{WS}*\n")
    return F.array_join(F.filter(F.transform(blocks, joined), lambda x: x != ""), "\n\n")


def without_lines(c: Column, phrases: Sequence[str]) -> Column:
    """The lines of a text without addresses and without those that hold a phrase."""
    return strip(F.array_join(F.filter(F.split(c, LINE_ENDS), lambda x: ~F.contains(x, F.lit("@")) & ~_any(F.lower(x), phrases)), "\n"))


def clean_unit(c: Column) -> Column:
    """A unit's text for evidence cards; the text itself if nothing would be left."""
    return let(without_lines(unwrap_lines(c), L.UNIT_NOISE), lambda x: F.when(x != "", x).otherwise(c))


def clean_for_knowledge(c: Column) -> Column:
    """A section's text for concepts and facts: from an early 'Abstract' on, without addresses and notices; never nothing."""
    at = F.instr(c, F.lit("Abstract"))
    body = F.when(at.between(1, 2001), F.substring(c, at, F.length(c))).otherwise(c)
    return unwrap_lines(let(without_lines(body, L.KNOWLEDGE_NOISE), lambda x: F.when(x != "", x).otherwise(c)))


def _before(c: Column, pattern: str, flags: str = "") -> Column:
    """What stands before the first place where the pattern matches; an empty text if nowhere."""
    return F.regexp_extract(c, rf"(?isU{flags})\A(.*?){pattern}", 1)


def trim_matter(c: Column) -> Column:
    """A paper's text without what comes before its abstract, and without the references if these begin late."""
    alone = r"(?:^|\n)\s*(?:references|bibliography)\s*(?:\n|$)"

    def cut(t: Column) -> Column:
        kept = F.when(t.rlike(f"(?iUmd){alone}"), _before(t, alone, "md")).otherwise(_before(t, r"\breferences\b"))
        return let(kept, lambda x: F.when(F.length(x) > F.greatest(F.lit(2500), F.length(t) * 0.45), x).otherwise(t))

    return let(F.substring(c, F.length(_before(F.substring(c, 1, 6000), r"\babstract\b")) + 1, F.length(c)), cut)


def section_title(c: Column, ordinal: Column) -> Column:
    """The first line if it is a heading, else the beginning of the first sentence, else a number."""
    line = strip(F.get(F.split(c, LINE_ENDS), F.lit(0)))
    sentence = strip(F.get(F.split(strip(c), rf"[。！？!?.]{WS}+", 2), F.lit(0)))
    begun = trim_edges(F.substring(sentence, 1, 72))
    other = let(begun, lambda x: F.when(x != "", x).otherwise(F.concat(F.lit("Semantic section "), ordinal.cast("string"))))
    return let(line, lambda x: F.when(is_heading(x), F.substring(x, 1, 80)).otherwise(other))


def is_card_sentence(c: Column) -> Column:
    return let(F.length(strip(c)), lambda n: (n <= 500) & F.when(contains_cjk(c), n >= 16).otherwise(n >= 35))


def specific_enough(c: Column) -> Column:
    return let(normalize_text(c), lambda n: (F.length(n) >= 2) & ~n.isin(*L.GENERIC_TERMS))


def card_type(c: Column) -> Column:
    return let(F.lower(c), lambda low: _cases([(_any(c, zh) | _any(low, en), name) for name, zh, en in L.CARD_TYPES], L.DEFAULT_CARD_TYPE))


def card_quality(c: Column, kind: Column) -> Column:
    points = F.lit(55) + F.when(kind.isin(*L.REASONING_TYPES), 20).otherwise(0) + F.when(let(F.lower(c), lambda low: _any(low, L.QUALITY_EN)), 10).otherwise(0)
    points = points + F.when(_any(c, L.QUALITY_ZH), 10).otherwise(0) + F.when(F.length(c) > 120, 5).otherwise(0)
    return F.least(points, F.lit(95)) / 100


def reasoning_hook(kind: Column) -> Column:
    return _mapped(kind, L.REASONING_HOOKS, L.DEFAULT_HOOK)


def event_label(c: Column) -> Column:
    """One of the compact labels, or an empty string."""
    low = F.lower(c)
    has = lambda t: F.contains(low, F.lit(t))
    raw = lambda t: F.contains(c, F.lit(t))
    return _cases(
        [
            (has("chunk") & (raw("生成问题") | has("question")), L.EVENT_LABELS[0]),
            (has("concept") & has("fact") & (has("graph") | raw("图")), L.EVENT_LABELS[1]),
            (has("fact") & has("evidence") & (raw("不能") | has("must") | has("cannot")), L.EVENT_LABELS[2]),
            (has("pipeline") & has("qa"), L.EVENT_LABELS[3]),
            (raw("文档外知识"), L.EVENT_LABELS[4]),
        ],
        "",
    )


def told_event(c: Column, subject: Column) -> Column:
    """The sentence without the first mention of the subject, 60 characters at most."""
    at = F.instr(c, subject)
    rest = F.when((at > 0) & (F.length(subject) > 0), F.concat(c.substr(F.lit(1), at - 1), c.substr(at + F.length(subject), F.length(c)))).otherwise(c)
    return let(trim_edges(rest), lambda r: F.when(F.length(r) <= 60, r).otherwise(trim_edges(F.substring(r, 1, 60), False)))


def infer_event(c: Column, subject: Column) -> Column:
    """The label, else what the sentence tells of the subject."""
    return let(event_label(c), lambda e: F.when(e != "", e).otherwise(told_event(c, subject)))


def infer_subject(c: Column, title: Column, keywords: Column, gap: str = r"\s") -> Column:
    """The title for CJK sentences, else the first specific phrase, keyword or the title; may be empty.  gap: what stands between a phrase's words."""
    found = F.regexp_extract_all(c, F.lit(rf"[A-Z][A-Za-z0-9_\-]{{2,}}(?:{gap}+[A-Z][A-Za-z0-9_\-]{{2,}})*|[{CJK}A-Za-z0-9_\-]{{2,12}}"), F.lit(0))
    # no phrase is looked at once there is one
    phrase = F.aggregate(found, F.lit(None).cast("string"), lambda done, x: F.coalesce(done, let(clean_short(x), lambda y: F.when(specific_enough(y), y))))
    word = F.get(F.filter(keywords, specific_enough), F.lit(0))
    own = F.when(specific_enough(title), title)
    return F.when(contains_cjk(c) & specific_enough(title), title).otherwise(F.coalesce(phrase, word, own, F.lit("")))


def section_subject(path: Column, title: Column) -> Column:
    own = clean_short(F.coalesce(title, F.lit("")))
    return F.coalesce(F.get(F.filter(F.transform(path, lambda x: clean_short(x)), specific_enough), F.lit(0)), F.when(specific_enough(own), own), F.lit(""))


def fact_type(c: Column) -> Column:
    return let(normalize_text(c), lambda n: _cases([(c.rlike(r"\d"), "numeric"), *[(_any(n, terms), name) for name, terms in L.FACT_TYPES]], "claim"))


def fact_confidence(c: Column) -> Column:
    points = F.lit(55) + F.when(F.length(c) >= 40, 10).otherwise(0) + F.when(c.rlike(r"\d"), 10).otherwise(0) + F.when(_any(c, L.CONFIDENCE_CUES), 10).otherwise(0)
    return F.least(points, F.lit(90)) / 100


def document_fact_type(c: Column) -> Column:
    return let(F.lower(c), lambda low: _cases([(c.rlike(r"\d"), "numeric"), *[(_any(low, terms), name) for name, terms in L.DOCUMENT_FACT_TYPES]], "claim"))


def document_fact_confidence(c: Column) -> Column:
    points = F.lit(60) + F.when(F.length(c) >= 20, 10).otherwise(0) + F.when(c.rlike(r"\d"), 10).otherwise(0) + F.when(_any(F.lower(c), L.DOCUMENT_CONFIDENCE_CUES), 10).otherwise(0)
    return F.least(points, F.lit(95)) / 100


def concept_type(c: Column) -> Column:
    return let(normalize_text(c), lambda n: _cases([(_any(n, terms), name) for name, terms in L.CONCEPT_TYPES], "term"))


def is_person_like(c: Column) -> Column:
    """Two to four words, each a capital and lower-case letters, points aside."""
    words = F.transform(F.split(strip(c), WS + "+"), lambda w: F.translate(w, ".", ""))
    tail = lambda w: F.substring(w, 2, 1000)
    ok = F.forall(words, lambda w: w.rlike(r"^[\p{Lu}\p{Lt}]") & (F.lower(tail(w)) == tail(w)) & (F.upper(tail(w)) != tail(w)))
    return F.size(words).between(2, 4) & ok


def is_metadata_phrase(c: Column) -> Column:
    low = F.lower(strip(c))
    return low.isin("abstract", "references", "appendix") | low.startswith("figure ") | low.startswith("table ")


def is_concept_name(c: Column) -> Column:
    return let(strip(c), lambda name: let(normalize_text(name), lambda norm: _is_name(name, norm)))


def _is_name(name: Column, norm: Column) -> Column:
    parts = F.transform(F.split(name, r"(?U)[\s\-]+"), normalize_text)
    bad = norm.isin(*L.PRONOUNS, *L.GENERIC_NAMES, *L.AFFILIATIONS) | F.exists(parts, lambda p: p.isin(*L.AFFILIATIONS))
    bad = bad | ((F.length(norm) <= 2) & ~name.rlike("[A-Z]{2,}")) | (name.rlike("^[a-z]+$") & ((F.length(name) <= 4) | ~norm.isin("bert", "gpt", "lstm")))
    return (norm != "") & ~bad & ~(is_person_like(name) & ~_any(norm, L.DOMAIN_KEYWORDS)) & ~is_metadata_phrase(name)


def keep_canonical(c: Column, importance: Column) -> Column:
    """The ordered rules that say which canonical concepts stay."""
    return let(strip(c), lambda name: let(normalize_text(name), lambda norm: _keep(name, norm, importance)))


def _keep(name: Column, norm: Column, importance: Column) -> Column:
    listed = norm.isin(*L.DOMAIN_ALLOWLIST)
    return (
        F.when((norm == "") | norm.isin(*L.CANONICAL_BLACKLIST) | is_person_like(name), False)
        .when(name.rlike("^[A-Z][a-z]+$") & ~listed, False)
        .when(name.rlike("^[A-Za-z]+$") & ~listed & (importance < 0.8), False)
        .when(name.rlike("^[A-Z]{2,}$") | _any(norm, L.DOMAIN_ALLOWLIST), True)
        .when(F.contains(name, F.lit(" ")) & (importance >= 0.7), True)
        .otherwise(importance >= 0.9)
    )


def relation_type(kind: Column) -> Column:
    return _mapped(kind, L.RELATIONS, L.DEFAULT_RELATION)


def combination_pattern(types: Column) -> Column:
    return _cases([(F.array_contains(types, t), p) for t, p in L.PATTERNS], L.DEFAULT_PATTERN)


def difficulty(n: Column) -> Column:
    return F.when(n >= 4, "hard").when(n >= 2, "medium").otherwise("easy")


def question_type(pattern: Column) -> Column:
    return _mapped(pattern, L.QUESTION_TYPES, L.DEFAULT_PATTERN)


def intended_question(kind: Column) -> Column:
    return _mapped(kind, L.INTENDED_QUESTIONS, L.DEFAULT_INTENDED)


def rendered_question(kind: Column, intended: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in L.RENDERED_QUESTIONS.items()], F.concat(F.regexp_replace(intended, "。+$", ""), F.lit("？")))


def is_over_specific(c: Column) -> Column:
    return (F.regexp_count(c, F.lit("[,，]")) >= 4) | c.rlike(r"\([^?()]{35,}\)") | (F.regexp_count(c, F.lit(r"(?i)\b(?:and|with|via|through)\b")) >= 4)


def has_question_shape(c: Column) -> Column:
    return _any(F.lower(c), L.QUESTION_SHAPE_EN) | _any(c, L.QUESTION_SHAPE_ZH)


def polish_question(c: Column) -> Column:
    """Without long parentheses, two stiff forms reworded; over-specific ones are left to ``simplify_question``."""
    q = collapse(F.regexp_replace(clean_question(c), r"\s*\([^?()]{35,}\)", ""))
    q = F.regexp_replace(q, r"(?i)^Why does (.+?) require (?:three|several|multiple|distinct|\d+)?\s*.*?mechanisms?.*? over (.+?)\??$", "What mechanisms make $1 better than $2?")
    q = F.regexp_replace(q, r"(?i)^Why does (.+?) achieve (?:its )?performance advantages over (.+?)\??$", "What makes $1 better than $2?")
    return clean_question(q)


def simplify_question(c: Column, subjects: Column, claims: Column, types: Column) -> Column:
    """A shorter question about the cards' subjects; null if there is none to make."""
    low, about = F.lower(c), F.lower(claims)
    either = lambda *t: _any(low, t)
    known = F.filter(subjects, specific_enough)
    pair = (either("transformer") | F.contains(about, F.lit("transformer"))) & (either("recurrent", "rnn") | F.contains(about, F.lit("recurrent")))
    mechanical = F.exists(types, lambda t: t.isin("mechanism", "cause_effect", "core_claim"))
    second = F.coalesce(F.get(known, F.lit(1)), F.lit("the related mechanism"))
    return (
        F.when(F.size(subjects) == 0, None)
        .when(pair & mechanical, "What mechanisms make the Transformer architecture better than recurrent neural networks?")
        .when(pair, "What makes the Transformer architecture better than recurrent neural networks?")
        .when(F.size(F.array_distinct(known)) == 1, F.concat(F.lit("What explains "), F.get(known, F.lit(0)), F.lit("'s main advantage in the article?")))
        .when(F.size(known) > 0, F.concat(F.lit("How are "), F.get(known, F.lit(0)), F.lit(" and "), second, F.lit(" connected in the article?")))
    )


def json_object(c: Column) -> Column:
    """The text as a JSON value, else what stands between its first { and last }."""
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(F.regexp_extract(c, r"(?s)\{.*\}", 0)))


def bounded(c: Column, default: float) -> Column:
    """A number in 0 to 1 from whatever was given, else the default."""
    number = c.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(default)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def best_of_scores(centrality: Column, reasoning: Column, evidence: Column, novelty: Column, synthesis: Column) -> Column:
    return F.round(centrality * 0.25 + reasoning * 0.3 + evidence * 0.2 + novelty * 0.1 + synthesis * 0.15, 3)


def target_section_range(chars: Column, per_40k: int = 10, most: int = 6500, tolerance: float = 0.35) -> Column:
    """struct(low, high): how many sections a document of so many characters should have."""
    target = F.greatest(F.lit(1.0), F.bround(chars / 40000 * per_40k, 0), F.ceil(chars / most).cast("double"))
    low = F.greatest(F.lit(1), F.floor(target * (1 - tolerance)).cast("int"))
    return F.struct(low.alias("low"), F.greatest(low, F.ceil(target * (1 + tolerance)).cast("int")).alias("high"))
