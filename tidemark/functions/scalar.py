"""Expressions that the operators share. All stay in the JVM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def growth(now: Column, before: Column) -> Column:
    """now / before - 1, null where before is 0 or null."""
    return ratio(now, before) - F.lit(1.0)


def gated(value: Column, counted: Column, window: WindowSpec, least: int) -> Column:
    """A window aggregate, null until `least` non-null inputs lie in its frame."""
    return F.when(F.count(counted).over(window) >= least, value)


def zscore(x: Column, window: WindowSpec, least: int = 1) -> Column:
    """(x - mean) / sample deviation over the window; null where the deviation is 0."""
    return gated(ratio(x - F.avg(x).over(window), F.stddev_samp(x).over(window)), x, window, least)


def pct_rank(x: Column, window: WindowSpec, least: int = 1) -> Column:
    """Average rank of x among the non-null values of its frame, as a share of their number."""
    seen = F.collect_list(x).over(window)
    less, equal = F.size(F.filter(seen, lambda v: v < x)), F.size(F.filter(seen, lambda v: v == x))
    return F.when(x.isNotNull(), gated((less + (equal + 1) / 2) / F.size(seen), x, window, least))


def correlation(x: Column, y: Column, window: WindowSpec) -> Column:
    """Pearson's r over the window's rows that have both; null where either is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    cov = F.avg(a * b).over(window) - F.avg(a).over(window) * F.avg(b).over(window)
    return ratio(cov, F.stddev_pop(a).over(window) * F.stddev_pop(b).over(window))


def slug(text: Column) -> Column:
    """Lower-case letters and digits, all else as single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def collapse(text: Column) -> Column:
    """Runs of white space as one blank, none outside."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def unescape(text: Column) -> Column:
    """Character references decoded once: numbers and the names of HTML 4. Those of spaces give a blank, unknown ones stay."""
    names = F.create_map(*(F.lit(x) for pair in {**name2codepoint, "apos": 39}.items() for x in pair))

    def one(piece: Column) -> Column:
        ref = F.regexp_extract(piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,30});", 1)
        code = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10).try_cast("int")).when(ref.startswith("#"), F.substring(ref, 2, 7).try_cast("int")).otherwise(F.try_element_at(names, ref))
        code = F.when((code == 160) | code.between(8192, 8202) | code.isin(8239, 8287, 12288), 32).when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), code)
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(sign, F.substr(piece, F.length(ref) + 2)))

    pieces = F.split(text, "&")
    after = F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), "")
    return F.when(F.contains(text, F.lit("&")), F.concat(F.element_at(pieces, 1), after)).otherwise(text)


def html_text(html: Column, most: int | None = None) -> Column:
    """The text of a HTML page: scripts, styles, comments and tags out, character references decoded, white space collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = collapse(unescape(F.regexp_replace(text, r"(?s)<[^>]*>", " ")))
    return F.substring(text, 1, most) if most else text


def number(text: Column) -> Column:
    """A double, null where the text is no number."""
    return F.try_cast(F.trim(text.cast("string")), "double") if hasattr(F, "try_cast") else text.try_cast("double")


def epoch(x: Column, unit: str = "s") -> Column:
    """A timestamp from seconds or milliseconds since 1970."""
    return F.timestamp_millis(x.cast("long")) if unit == "ms" else F.timestamp_seconds(x.cast("double"))


def text_contains(column: Column, words: str) -> Column:
    """Whether the text holds `words`, whatever their case; % and _ are ordinary signs."""
    return F.contains(F.lower(column), F.lit(words.lower()))
