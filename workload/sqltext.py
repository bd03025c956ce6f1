"""DuckDB spellings of the column functions, used to write the checking SQL."""

from __future__ import annotations

IPV4 = (
    r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    r"(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
)


def domain(x: str) -> str:
    h = f"lower(trim({x}, ' '))"
    for pattern in (r"^[a-z][a-z0-9+.-]*://", r"[/?#].*$", r":[0-9]+$", r"^www\."):
        h = f"regexp_replace({h}, '{pattern}', '')"
    return f"nullif({h}, '')"


def host(x: str) -> str:
    return f"nullif(regexp_extract({x}, '^[a-z]+://([^/?#:]+)', 1), '')"


def ip_number(x: str) -> str:
    octet = lambda i: f"try_cast(split_part({x}, '.', {i}) as bigint)"
    return (
        f"case when regexp_matches({x}, '{IPV4}') then "
        f"{octet(1)} * 16777216 + {octet(2)} * 65536 + {octet(3)} * 256 + {octet(4)} end"
    )


def trio(x: str) -> str:
    return f"split_part({x}, '.', 1) || '.' || split_part({x}, '.', 2) || '.' || split_part({x}, '.', 3)"


def city(x: str) -> str:
    flat = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'), ' ')"
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split({flat}, ' ')], ' ')"


def words(x: str) -> str:
    flat = f"trim(regexp_replace({x}, '[\\x00-\\x20\\x7f]+', ' ', 'g'), ' ')"
    return f"(case when {x} is null then null when {flat} = '' then [] else string_split({flat}, ' ') end)"


def head(ws: str, n: int) -> str:
    return f"array_to_string({ws}[1:{n}], ' ')"


def clean(x: str, n: int) -> str:
    return head(words(f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"), n)


def first_words(x: str, n: int) -> str:
    return head(words(x), n)


def filtered(x: str, n: int) -> str:
    flat = f"trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"
    return head(f"list_filter(string_split({flat}, ' '), lambda w: length(w) > 1)", n)


def ngrams(ws: str) -> str:
    """Distinct 1- to 3-grams of a word list column, unordered."""
    two = f"[{ws}[i] || ' ' || {ws}[i + 1] for i in range(1, len({ws}))]"
    three = f"[{ws}[i] || ' ' || {ws}[i + 1] || ' ' || {ws}[i + 2] for i in range(1, len({ws}) - 1)]"
    return f"list_distinct(list_concat({ws}, list_concat({two}, {three})))"


def day(x: str) -> str:
    formats = ("%d-%m-%Y", "%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%Y%m%d")
    return "coalesce(" + ", ".join(f"cast(try_strptime({x}, '{f}') as date)" for f in formats) + ")"


TOPIC_LIST = (
    '[{"parentCategory":"VARCHAR","category":"VARCHAR","topic":"VARCHAR","probability":"VARCHAR"}]'
)


def topics(x: str) -> str:
    return f"from_json({x}, '{TOPIC_LIST}')"


def strict_greatest(*xs: str) -> str:
    none = " or ".join(f"{x} is null" for x in xs)
    return f"case when {none} then null else greatest({', '.join(xs)}) end"
