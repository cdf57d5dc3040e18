"""DuckDB fragments of the text rules, for the SQL that results are compared with."""

from __future__ import annotations

from gleaner.functions import lexicons as L

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
CJK = "一-鿿"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def names(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def norm(x: str) -> str:
    return f"regexp_replace(lower({collapse(x)}), '[^\\p{{L}}\\p{{N}}_ -]', '', 'g')"


def has(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(t)})" for t in terms) + ")"


def sentences(x: str) -> str:
    marked = f"regexp_replace({x}, '([。！？!?.]){WS}+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({norm(x)}, '[A-Za-z][A-Za-z0-9_\\-]{{2,}}|[{CJK}]{{2,}}')"


def section_tokens(x: str) -> str:
    """For texts without CJK runs of more than two characters."""
    return f"list_filter(regexp_extract_all({norm(x)}, '[a-z][a-z0-9_\\-]{{2,}}|[{CJK}]{{2,}}'), lambda s: s NOT IN {names(L.SECTION_STOPWORDS)})"


def overlap(a: str, b: str) -> str:
    x, y = f"list_distinct({tokens(a)})", f"list_distinct({tokens(b)})"
    return f"CASE WHEN len({x}) > 0 AND len({y}) > 0 THEN len(list_intersect({x}, {y})) / len({x}) ELSE 0.0 END"


def loose(topic: str, text: str) -> str:
    t = tokens(topic)
    return f"(len({t}) > 0 AND len(list_filter({t}, lambda s: contains({text}, s))) >= greatest(1, len({t}) // 2))"


def cases(pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {q(v)}" for c, v in pairs) + f" ELSE {q(default)} END"


def card_type(x: str) -> str:
    return cases([(f"{has(x, zh)} OR {has(f'lower({x})', en)}", n) for n, zh, en in L.CARD_TYPES], L.DEFAULT_CARD_TYPE)


def card_quality(x: str, kind: str) -> str:
    return f"least(95, 55 + CASE WHEN {kind} IN {names(L.REASONING_TYPES)} THEN 20 ELSE 0 END + CASE WHEN {has(f'lower({x})', L.QUALITY_EN)} THEN 10 ELSE 0 END + CASE WHEN {has(x, L.QUALITY_ZH)} THEN 10 ELSE 0 END + CASE WHEN length({x}) > 120 THEN 5 ELSE 0 END) / 100"


def is_card_sentence(x: str) -> str:
    n = f"length({strip(x)})"
    return f"({n} <= 500 AND CASE WHEN regexp_matches({x}, '[{CJK}]') THEN {n} >= 16 ELSE {n} >= 35 END)"


def fact_type(x: str) -> str:
    return cases([(f"regexp_matches({x}, '[0-9]')", "numeric"), *[(has(norm(x), t), n) for n, t in L.FACT_TYPES]], "claim")


def fact_confidence(x: str) -> str:
    return f"least(90, 55 + CASE WHEN length({x}) >= 40 THEN 10 ELSE 0 END + CASE WHEN regexp_matches({x}, '[0-9]') THEN 10 ELSE 0 END + CASE WHEN {has(x, L.CONFIDENCE_CUES)} THEN 10 ELSE 0 END) / 100"


def document_fact_type(x: str) -> str:
    return cases([(f"regexp_matches({x}, '[0-9]')", "numeric"), *[(has(f"lower({x})", t), n) for n, t in L.DOCUMENT_FACT_TYPES]], "claim")


def document_fact_confidence(x: str) -> str:
    return f"least(95, 60 + CASE WHEN length({x}) >= 20 THEN 10 ELSE 0 END + CASE WHEN regexp_matches({x}, '[0-9]') THEN 10 ELSE 0 END + CASE WHEN {has(f'lower({x})', L.DOCUMENT_CONFIDENCE_CUES)} THEN 10 ELSE 0 END) / 100"


def is_upper(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


def is_heading(x: str) -> str:
    words = f"len(list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> ''))"
    return f"({x} <> '' AND length({x}) <= 120 AND (regexp_matches({x}, '^(?:\\d+(?:\\.\\d+)*|[A-Z])[.)]\\s+\\S+') OR starts_with({x}, '#') OR ({is_upper(x)} AND {words} <= 12 AND regexp_matches({x}, '\\p{{L}}'))))"


def is_page_number(x: str) -> str:
    return f"(regexp_matches(lower({x}), '^(?:page\\s*)?\\d{{1,4}}$') OR regexp_matches({x}, '^-\\s*\\d{{1,4}}\\s*-$'))"


def specific(x: str) -> str:
    return f"(length({norm(x)}) >= 2 AND {norm(x)} NOT IN {names(L.GENERIC_TERMS)})"


def short(x: str) -> str:
    return f"trim(substring({collapse(x)}, 1, 120), ' ，,。.;；')"


def concept_type(x: str) -> str:
    return cases([(has(norm(x), t), n) for n, t in L.CONCEPT_TYPES], "term")


def person(x: str) -> str:
    words = f"list_transform(regexp_split_to_array({strip(x)}, '{WS}+'), lambda w: replace(w, '.', ''))"
    ok = "regexp_matches(w, '^[\\p{Lu}\\p{Lt}]') AND lower(substring(w, 2, 1000)) = substring(w, 2, 1000) AND upper(substring(w, 2, 1000)) <> substring(w, 2, 1000)"
    return f"(len({words}) BETWEEN 2 AND 4 AND len(list_filter({words}, lambda w: NOT ({ok}))) = 0)"


def keep_canonical(x: str, importance: str) -> str:
    n, s = norm(x), strip(x)
    listed = f"{n} IN {names(L.DOMAIN_ALLOWLIST)}"
    return (
        f"CASE WHEN {n} = '' OR {n} IN {names(L.CANONICAL_BLACKLIST)} OR {person(s)} THEN false WHEN regexp_matches({s}, '^[A-Z][a-z]+$') AND NOT {listed} THEN false "
        f"WHEN regexp_matches({s}, '^[A-Za-z]+$') AND NOT {listed} AND {importance} < 0.8 THEN false WHEN regexp_matches({s}, '^[A-Z]{{2,}}$') OR {has(n, L.DOMAIN_ALLOWLIST)} THEN true "
        f"WHEN contains({s}, ' ') AND {importance} >= 0.7 THEN true ELSE {importance} >= 0.9 END"
    )


def over_specific(x: str) -> str:
    return f"(len(regexp_extract_all({x}, '[,，]')) >= 4 OR regexp_matches({x}, '\\([^?()]{{35,}}\\)') OR len(regexp_extract_all({x}, '(?i)\\b(?:and|with|via|through)\\b')) >= 4)"


def question(x: str) -> str:
    c = collapse(x)
    return f"CASE WHEN {c} <> '' AND NOT regexp_matches({c}, '[？?]$') THEN {c} || '？' ELSE {c} END"


def mapped(x: str, table: dict[str, str], default: str) -> str:
    return cases([(f"{x} = {q(k)}", v) for k, v in table.items()], default)


def stable_id(prefix: str, x: str) -> str:
    return f"'{prefix}_' || substring(sha1({x}), 1, 10)"
