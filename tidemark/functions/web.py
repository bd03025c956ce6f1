"""Column expressions for hosts, addresses, dates and places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a day, tried in this order.
DAY_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "yyyyMMdd")

IPV4 = (
    r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    r"(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
)


# scheme, "www.", then the name up to port, path, query or fragment
HOST_NAME = r"^(?:[a-z][a-z0-9+.-]*://)?(?:www\.)?([^/?#]*?)(?::[0-9]+)?(?:[/?#]|$)"
# what may end the name before the text does: its marks, and a last line break
NAME_ENDS = ":/?#\n\r\u0085\u2028\u2029"


def domain_normalizer(host: Column) -> Column:
    """Comparable host name: lower case, no scheme, ``www.``, port or path; NULL if empty."""
    name = F.lower(F.trim(host))
    # most are bare names already, of which the pattern only takes "www."; matching costs much more
    bare = F.lit(True)
    for mark in NAME_ENDS:
        bare = bare & ~F.contains(name, F.lit(mark))
    short = F.when(F.startswith(name, F.lit("www.")), F.substring(name, 5, 1 << 30)).otherwise(name)
    return F.nullif(F.when(bare, short).otherwise(F.regexp_extract(name, HOST_NAME, 1)), F.lit(""))


def url_host(url: Column) -> Column:
    """Host of a URL, or NULL when the text is not a URL."""
    return F.try_parse_url(url, F.lit("HOST"))


def ip_to_number(ip: Column) -> Column:
    """IPv4 dotted quad as an ordered bigint; NULL for anything else."""
    octets = F.split(ip, r"\.")
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = value * 256 + F.get(octets, F.lit(i)).try_cast("bigint")
    return F.when(ip.rlike(IPV4), value)


def ip_trio(ip: Column) -> Column:
    """First three octets of a dotted quad."""
    return F.concat_ws(
        ".",
        F.split_part(ip, F.lit("."), F.lit(1)),
        F.split_part(ip, F.lit("."), F.lit(2)),
        F.split_part(ip, F.lit("."), F.lit(3)),
    )


def to_day(text: Column, formats: tuple[str, ...] = DAY_FORMATS) -> Column:
    """Day written in any of the accepted spellings; NULL if none fits."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def date_normalizer(text: Column) -> Column:
    """Day in any accepted spelling, rewritten as ``dd-MM-yyyy`` text."""
    return F.date_format(to_day(text), "dd-MM-yyyy")


def normalize_city(city: Column) -> Column:
    """City name with single blanks and capitalised words."""
    return F.initcap(F.trim(F.regexp_replace(city, r"\s+", " ")))
