"""Fill-in-middle transformation by counted-quantifier regular expressions (operator 11).

A unit is one code point, ``(?s).``. ``regexp_count`` gives a text's number of
units, two keyed hashes cut it after a and b of them, and a pattern built for
the row, ``\\A(unit{a}+)(unit{b-a}+)(unit*+)``, matches all three parts at once;
the replacement puts them in the order of the form. The counted possessive
groups never backtrack, so a match is one walk over the text. Everything is a
column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Prefix, suffix and middle marks of the output, a fixed choice of the contract.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 documents, those that are left plain, and of the others, those in suffix-prefix-middle order.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Units counted by one match: a count makes one short-lived string per match, so a very long text makes few.
BLOCK = 4096


def units(text: Column, block: int = BLOCK) -> Column:
    """Number of code points: whole blocks by counted matches, then the rest one by one."""
    whole = F.regexp_count(text, F.lit(f"(?s).{{{block}}}+"))
    rest = F.substring(text, whole * block + 1, F.lit(block))
    return whole.cast("long") * block + F.regexp_count(rest, F.lit("(?s)."))


def keyed(key: Column, salt: int, k: int) -> Column:
    """The k-th (0 to 3) 8-digit group of the hex sha256 of ``salt:key``, as a number (a null key is empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _literal(text: str) -> str:
    """``text`` as itself within a Java replacement."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _separable(marks: tuple[str, ...]) -> bool:
    """Whether each mark's first occurrence in an output is the one written (the text holds none itself)."""
    apart = all(x not in y for i, x in enumerate(marks) for j, y in enumerate(marks) if i != j)
    return all(marks) and apart and not any(x[:k] == x[-k:] for x in marks for k in range(1, len(x)))


def cut(text: Column, a: Column, b: Column, replacement: Column) -> Column:
    """``replacement`` with $1, $2, $3 for the first a units, the next b - a and the rest, in one match."""
    pattern = F.concat(F.lit("(?s)\\A(.{"), a.cast("string"), F.lit("}+)(.{"), (b - a).cast("string"), F.lit("}+)(.*+)\\z"))
    return F.regexp_replace(text, pattern, replacement)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", salt: int = 1, plain_percent: int = PLAIN_PERCENT,
              spm_percent: int = SPM_PERCENT, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Key, n, form, prefix_chars, middle_chars and output of every document.

    A document is plain (output equal to its text, no cuts) if the text is null
    or empty, holds a mark, or its third hash modulo 100 is among the
    ``plain_percent`` largest; else spm or psm by the fourth hash. Cuts and form depend only on the
    key and the text's length, so repeated rows get the same result; a null key
    counts as an empty one. A text of any length is cut by one match. Extra
    columns are not read; an empty table gives no rows.
    """
    p, s, m = marks
    if not _separable(marks):
        raise ValueError("marks must be distinct, none within another, and none ending as it begins")
    h1, h2, h3, h4 = (F.col(f"_h{k}") for k in range(1, 5))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select("_key", "_text", units(F.col("_text")).alias("_n"),
                       *(keyed(F.col("_key"), salt, k).alias(f"_h{k + 1}") for k in range(4)))
    marked = F.lit(False)
    for x in marks:
        marked = marked | F.col("_text").contains(x)
    plain = (F.col("_n") == 0) | marked | (h3 % 100 >= 100 - plain_percent)
    first, second = h1 % (F.col("_n") + 1), h2 % (F.col("_n") + 1)
    rows = rows.select(
        "_key", "_text", "_n", F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm").alias("_form"),
        F.least(first, second).alias("_a"), F.greatest(first, second).alias("_b"))
    order = F.when(F.col("_form") == "spm", f"{_literal(s)}$3{_literal(p)}$1{_literal(m)}$2").otherwise(
        f"{_literal(p)}$1{_literal(s)}$3{_literal(m)}$2")
    output = F.when(F.col("_form") == "plain", F.col("_text")).otherwise(cut(F.col("_text"), F.col("_a"), F.col("_b"), order))
    parted = F.col("_form") != "plain"
    return rows.select(
        F.col("_key").alias(key), F.col("_n").alias("n"), F.col("_form").alias("form"), F.when(parted, F.col("_a")).alias("prefix_chars"),
        F.when(parted, F.col("_b") - F.col("_a")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text of an output and its form (a text with marks is always plain, so the marks are found again)."""
    p, s, m = map(_quoted, marks)
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 11 over all documents."""
    rows = transform(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


#: The same rows by substrings instead of patterns.
SQL = """
with d as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
k as (
  select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as x, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as y,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                or ('0x' || substr(h, 17, 8))::bigint % 100 >= 90 then 'plain'
              when ('0x' || substr(h, 25, 8))::bigint % 100 < 20 then 'spm' else 'psm' end as form from d),
c as (
  select *, substring(t, 1, least(x, y)) as p, substring(t, least(x, y) + 1, abs(x - y)) as m,
         substring(t, greatest(x, y) + 1) as s from k)
select doc_id, n::bigint as n, form, case when form <> 'plain' then least(x, y) end as prefix_chars,
       case when form <> 'plain' then abs(x - y) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from c
"""
