"""Column functions for strict CSV line handling and header names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdrflow.mapping import COLUMN_NAME_MAX


def _hex(ch: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in ch)


def strip_eol(line) -> Column:
    """Remove every trailing CR / LF."""
    return F.regexp_replace(line, r"[\r\n]+\z", "")


def quote_count(line, quote: str = '"') -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def odd_quotes(line, quote: str = '"') -> Column:
    """True when the enclosure character appears an odd number of times."""
    return (quote_count(line, quote) % 2) != 0


def split_fields(line, delimiter: str = ",", quote: str = '"') -> Column:
    """All fields of a line as an array of strings, unquoted.

    A quoted section opens only at the start of a field, after optional blanks,
    which are dropped; inside it a doubled enclosure is one enclosure; text
    after it stays.  Linear regex (possessive quantifiers), safe on long lines.

    Almost every line is plain: each field is without an enclosure, or all of
    it is between two and holds no delimiter.  Then the outer enclosures go in
    one replacement, and the line is split where the delimiters are.
    """
    d, q = _hex(delimiter), _hex(quote)
    inner = rf"(?:[^{d}{q}]++|{q}{q})*+"
    is_plain = line.rlike(rf"\A(?:{q}{inner}{q}|[^{d}{q}]*+)(?:{d}(?:{q}{inner}{q}|[^{d}{q}]*+))*+\z")
    opened_up = F.regexp_replace(line, rf"(?:(?<={d})|\A){q}({inner}){q}(?={d}|\z)", "$1")
    simple = F.split(F.replace(opened_up, F.lit(quote * 2), F.lit(quote)), d)
    # every field is matched together with the delimiter in front of it (one
    # is prepended), so no match is empty and no field is skipped
    token = rf"{d}((?:[ \t]*+{q}(?:[^{q}]++|{q}{q})*+{q}[^{d}]*+)|[^{d}]*+)"
    toks = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(token), 1)
    opened = rf"\A[ \t]*+{q}((?:[^{q}]++|{q}{q})*+){q}"

    def unquote(t: Column) -> Column:
        # almost every quoted field is just quote, text, quote: no pattern is needed
        body = F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit(quote * 2), F.lit(""))
        plain = F.startswith(t, F.lit(quote)) & F.endswith(t, F.lit(quote)) & (F.length(t) > 1) & ~F.contains(body, F.lit(quote))
        inner = F.when(plain, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(F.regexp_replace(t, opened, "$1"))
        return F.when(
            F.contains(t, F.lit(quote)) & t.rlike(rf"\A[ \t]*+{q}"), F.replace(inner, F.lit(quote * 2), F.lit(quote))
        ).otherwise(t)

    return F.when(is_plain, simple).otherwise(F.transform(toks, unquote))


def _base_name(x: Column) -> Column:
    # Runs of anything but ASCII letters/digits -> '_' (before upper-casing,
    # so non-ASCII letters never turn into ASCII ones), strip '_', prefix C_
    # when not starting with a letter, cut to 30.
    s = F.upper(F.regexp_replace(x, r"[^A-Za-z0-9]+", "_"))
    s = F.regexp_replace(s, r"\A_+|_+\z", "")
    s = F.when(s.rlike(r"\A[A-Z]"), s).otherwise(F.concat(F.lit("C_"), s))
    return F.substring(s, 1, COLUMN_NAME_MAX)


def sanitize_columns(names) -> Column:
    """Header names -> unique storage names (array -> array).

    Each base name takes the first free candidate among ``base``,
    ``base[:27] + '_01'``, ``'_02'``, ... given the names already taken
    to its left (a left fold), so ``A, A_01, A`` gives ``A, A_01, A_02``.
    A free base is taken at once; only a clash searches, among as many
    candidates as there are taken names with the same beginning.
    """
    bases = F.transform(names, _base_name)

    def numbered(b: Column, i: Column) -> Column:
        suffix = F.concat(F.lit("_"), F.when(i < 100, F.lpad(i.cast("string"), 2, "0")).otherwise(i.cast("string")))
        return F.concat(F.substring(b, F.lit(1), F.lit(COLUMN_NAME_MAX) - F.length(suffix)), suffix)

    def next_free(acc: Column, b: Column) -> Column:
        # a suffix shortens the base by at most as many characters as it has
        begin = F.substring(b, 1, COLUMN_NAME_MAX - 8)
        alike = F.size(F.filter(acc, lambda c: F.startswith(c, begin)))
        return F.element_at(F.array_except(F.transform(F.sequence(F.lit(1), alike + 1), lambda i: numbered(b, i)), acc), 1)

    def step(acc: Column, b: Column) -> Column:
        return F.concat(acc, F.array(F.when(~F.array_contains(acc, b), b).otherwise(next_free(acc, b))))

    return F.aggregate(bases, F.array().cast("array<string>"), step)
