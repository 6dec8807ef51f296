"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions.

Leaves are paragraphs: lines, cut after sentence ends and after ``LONGEST`` characters where a
line has none. A paragraph whose digest begins with 0 or 1 ends a section, so about eight make
one and an insertion moves no border but those beside it. A section's node is the digest of
its paragraphs' digests and lengths, the root that of the sections' nodes.

A fingerprint is text: ``root:node=leaf,leaf;node=leaf...``, a leaf being ``digest.length``.
The root is whole, so roots test equality; nodes and leaves are shortened to 16 hex digits,
enough to tell branches apart. Two trees are compared from the root down: equal roots end it,
equal sections are taken whole, and only paragraphs below differing sections are compared.
Likeness is twice the characters in equal branches over those of both trees, a repeated
branch counted once. Branches that differ first and last give the place of an edit.

The next document in order of id is found over ids alone, in pieces of a range exchange, and
sends what its predecessor needs of it: the first characters and its fingerprint. Texts
themselves move once, by their own id.

Defined results: a null text is an empty one, whose tree is a root without sections; empty
texts are alike, an empty and a filled one not at all; null ids come first; rows of one id
are ordered by a hash of the text; rows equal in id and text are one place in the order and
get equal results; a table of one document has itself as next; other columns are left out; an
empty table stays empty.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.common import stored

LONGEST = 256
PARAGRAPHS = rf"[^\n.!?]{{1,{LONGEST}}}[\n.!?]*|[\n.!?]+"
SHORT = 16
# Part of a text, in quarters, that its edited copy takes from the next document.
TAKEN = 4


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a text column (without nulls) as ``out``.

    Each step is a column of its own so that nothing is computed twice.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    leaves = F.transform(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(PARAGRAPHS), F.lit(0)),
                         lambda p: F.struct(F.sha2(p, 256).alias("h"), F.char_length(p).alias("n")))
    line = F.array_join(F.transform("_leaves", lambda x: F.concat(
        x["h"], F.lit("."), x["n"].cast("string"), F.when(x["h"] < "2", ";").otherwise(","))), "")
    sections = F.when(F.col("_line") == "", F.array().cast("array<string>")).otherwise(
        F.split(F.expr("substring(_line, 1, length(_line) - 1)"), ";"))
    nodes = F.transform("_sections", lambda s: F.struct(F.sha2(s, 256).alias("h"), F.regexp_replace(
        s, f"([0-9a-f]{{{SHORT}}})[0-9a-f]{{{64 - SHORT}}}", "$1").alias("leaves")))
    tree = F.concat(F.sha2(F.array_join(F.transform("_nodes", lambda x: x["h"]), ""), 256), F.lit(":"),
                    F.array_join(F.transform("_nodes", lambda x: F.concat(
                        F.substring(x["h"], 1, SHORT), F.lit("="), x["leaves"])), ";"))
    return (df.select(*columns, leaves.alias("_leaves")).select(*columns, line.alias("_line"))
            .select(*columns, sections.alias("_sections")).select(*columns, nodes.alias("_nodes"))
            .select(*columns, tree.alias(out)))


def root(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def sections(fingerprint: Column) -> Column:
    """Sections with their leaves, as texts."""
    rest = F.substring_index(fingerprint, ":", -1)
    return F.when(rest == "", F.array().cast("array<string>")).otherwise(F.split(rest, ";"))


def leaves(parts: Column) -> Column:
    """Leaves of sections, in order."""
    return F.flatten(F.transform(parts, lambda s: F.split(F.substring_index(s, "=", -1), ",")))


def chars(parts: Column) -> Column:
    """Characters that leaves stand for."""
    return F.aggregate(parts, F.lit(0).cast("long"),
                       lambda total, leaf: total + F.substring_index(leaf, ".", -1).cast("long"))


def with_likeness(df: DataFrame, one: str, other: str, out: str) -> DataFrame:
    """``df`` with the likeness of two fingerprint columns, 0 to 1, as ``out``."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    a, b = F.col(f"`{one}`"), F.col(f"`{other}`")
    parts = df.select(*columns, sections(a).alias("_a"), sections(b).alias("_b"))
    split = parts.select(*columns, chars(leaves(F.array_intersect("_a", "_b"))).alias("_same"),
                         F.array_distinct(leaves(F.array_except("_a", "_b"))).alias("_a"),
                         F.array_distinct(leaves(F.array_except("_b", "_a"))).alias("_b"))
    sums = split.select(*columns, "_same", chars(F.array_intersect("_a", "_b")).alias("_common"),
                        (chars(F.col("_a")) + chars(F.col("_b"))).alias("_rest"))
    likeness = F.when(root(a) == root(b), F.lit(1.0)).otherwise(
        2.0 * (F.col("_same") + F.col("_common")) / (2 * F.col("_same") + F.col("_rest")))
    return sums.select(*columns, likeness.alias(out))


def with_edit(df: DataFrame, one: str, other: str, start: str, end: str) -> DataFrame:
    """``df`` with the code points of ``one`` between which all differing paragraphs lie.

    ``start`` and ``end`` bound a half-open range; both are null where the roots are equal.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    a, b = F.col(f"`{one}`"), F.col(f"`{other}`")

    def equal_until(x: Column, y: Column) -> Column:
        """Leaves before the first pair that differs; a missing leaf differs from any."""
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        return F.when(at == 0, F.size(x)).otherwise(at - 1).cast("int")
    lists = df.select(*columns, leaves(sections(a)).alias("_a"), leaves(sections(b)).alias("_b"))
    ends = lists.select(*columns, "_a", F.least(F.size("_a"), F.size("_b")).alias("_shorter"),
                        equal_until(F.col("_a"), F.col("_b")).alias("_head"),
                        equal_until(F.reverse("_a"), F.reverse("_b")).alias("_tail"))
    # Paragraphs that head and tail both claim, as in a repeated line, stay with the head.
    head = F.col("_head")
    stop = F.size("_a") - F.least(F.col("_tail"), F.col("_shorter") - head)
    differ = root(a) != root(b)
    return ends.select(*columns, F.when(differ, chars(F.slice("_a", F.lit(1), head))).alias(start),
                       F.when(differ, chars(F.slice("_a", F.lit(1), stop))).alias(end))


# A row's place in the order: whether it has an id, the id (else 0), a hash of the text. As
# plain columns without nulls, one exchange by them serves grouping and joins alike.
KEY = ["has_id", "id", "h"]
BEFORE = [f"prev_{c}" for c in KEY]


def successors(keys: DataFrame) -> DataFrame:
    """For distinct keys with ``n`` characters: the key before each one, around the end.

    Returns ``KEY, BEFORE, taken``; ``taken`` is what the one before asks for.
    """
    pieces = stored(keys.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "order")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*KEY)) - 1
    # One row for each partition of the exchange.
    sizes = pieces.groupBy("part").agg(F.count("*").cast("long").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("since"))
    total = max(pieces.count(), 1)
    numbered = pieces.join(F.broadcast(starts), "part").select(*KEY, "n", (F.col("since") + inside).alias("place"))
    behind = numbered.select(((F.col("place") + 1) % total).alias("place"),
                             *(F.col(k).alias(b) for k, b in zip(KEY, BEFORE, strict=True)),
                             F.expr(f"cast(n div {TAKEN} as int)").alias("taken"))
    return numbered.join(behind, "place").select(*KEY, *BEFORE, "taken")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited copy, and their likeness, with the next one's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edit_start, edit_end``. The edited copy has the first characters of the next text, as many
    or all, in place of its last quarter (rounded down).
    """
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_col}`").cast("long")
    rows = df.select(doc.isNotNull().alias("has_id"), F.coalesce(doc, F.lit(0)).cast("long").alias("id"), body.alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = rows.groupBy(*KEY).agg(F.max(F.char_length("text")).alias("n"))

    heads = rows.join(successors(keys), KEY).select(*BEFORE, "text", F.expr("substring(text, 1, taken)").alias("head"))
    heads = (with_fingerprint(heads, "text", "next_fingerprint").select(*BEFORE, "head", "next_fingerprint")
             .dropDuplicates(BEFORE))

    met = rows.join(heads.select(*(F.col(b).alias(k) for k, b in zip(KEY, BEFORE, strict=True)), "head", "next_fingerprint"), KEY)
    met = met.withColumn("doc_id", F.when(F.col("has_id"), F.col("id")))
    n = F.char_length("text").cast("long")
    met = met.select("doc_id", "text", n.alias("n_chars"), "next_fingerprint", F.expr(
        f"concat(substring(text, 1, cast(length(text) - length(text) div {TAKEN} as int)), head)").alias("edited"))
    met = with_fingerprint(with_fingerprint(met, "text", "fingerprint"), "edited", "edited_fingerprint")
    met = met.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                     "edited_fingerprint", "next_fingerprint")
    met = with_likeness(met, "fingerprint", "edited_fingerprint", "near_edited")
    met = with_likeness(met, "fingerprint", "next_fingerprint", "near_next").drop("next_fingerprint")
    return with_edit(met, "fingerprint", "edited_fingerprint", "edit_start", "edit_end")


# The same tree in DuckDB; ids must be unique there, as in the given tables.
SQL = """
with docs as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
placed as (
  select *, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next from docs),
edited as (
  select *, substr(text, 1, n - n // 4) || substr(next, 1, n // 4) as edited from placed),
texts as (
  select distinct t from (select text as t from edited union all select edited from edited)),
leaf as (
  select t, list_transform(regexp_extract_all(t, '[^\\n.!?]{1,256}[\\n.!?]*|[\\n.!?]+'),
    lambda p: sha256(p) || '.' || length(p) || case when sha256(p) < '2' then ';' else ',' end) as l from texts),
line as (select t, array_to_string(l, '') as s from leaf),
parts as (select t, case when s = '' then []::varchar[] else string_split(left(s, length(s) - 1), ';') end as p from line),
tree as (
  select t, sha256(coalesce(array_to_string(list_transform(p, lambda s: sha256(s)), ''), '')) || ':' ||
    coalesce(array_to_string(list_transform(p, lambda s: left(sha256(s), 16) || '=' ||
      regexp_replace(s, '([0-9a-f]{16})[0-9a-f]{48}', '\\1', 'g')), ';'), '') as f from parts),
pairs as (
  select distinct a.f as a, b.f as b from edited e
    join tree a on a.t = e.text join tree b on b.t = e.edited or b.t = e.next),
branches as (
  select a, b, case when a[66:] = '' then []::varchar[] else string_split(a[66:], ';') end as sa,
    case when b[66:] = '' then []::varchar[] else string_split(b[66:], ';') end as sb from pairs),
lists as (
  select a, b, list_intersect(sa, sb) as same, list_filter(list_distinct(sa), lambda s: not list_contains(sb, s)) as ra,
    list_filter(list_distinct(sb), lambda s: not list_contains(sa, s)) as rb,
    flatten(list_transform(sa, lambda s: string_split(s[18:], ','))) as la,
    flatten(list_transform(sb, lambda s: string_split(s[18:], ','))) as lb from branches),
open as (
  select *, flatten(list_transform(same, lambda s: string_split(s[18:], ','))) as ls,
    list_distinct(flatten(list_transform(ra, lambda s: string_split(s[18:], ',')))) as da,
    list_distinct(flatten(list_transform(rb, lambda s: string_split(s[18:], ',')))) as db from lists),
sums as (
  select a, b, la, lb,
    coalesce(list_sum(list_transform(ls, lambda x: string_split(x, '.')[2]::bigint)), 0)::bigint as same,
    coalesce(list_sum(list_transform(list_intersect(da, db), lambda x: string_split(x, '.')[2]::bigint)), 0)::bigint as common,
    (coalesce(list_sum(list_transform(da, lambda x: string_split(x, '.')[2]::bigint)), 0) +
     coalesce(list_sum(list_transform(db, lambda x: string_split(x, '.')[2]::bigint)), 0))::bigint as rest,
    coalesce(list_position(list_transform(range(1, greatest(len(la), len(lb)) + 1),
      lambda i: la[i] is not distinct from lb[i]), false), 0) as head,
    coalesce(list_position(list_transform(range(1, greatest(len(la), len(lb)) + 1),
      lambda i: (list_reverse(la))[i] is not distinct from (list_reverse(lb))[i]), false), 0) as tail from open),
likeness as (
  select a, b, case when left(a, 64) = left(b, 64) then 1.0::double
      else 2.0::double * (same + common)::double / (2 * same + rest)::double end as near,
    coalesce(list_sum(list_transform(la[:case when head = 0 then len(la) else head - 1 end],
      lambda x: string_split(x, '.')[2]::bigint)), 0)::bigint as edit_start,
    coalesce(list_sum(list_transform(la[:len(la) - least(case when tail = 0 then len(la) else tail - 1 end,
      least(len(la), len(lb)) - case when head = 0 then len(la) else head - 1 end)],
      lambda x: string_split(x, '.')[2]::bigint)), 0)::bigint as edit_end from sums)
select e.doc_id, e.n::bigint as n_chars, sha256(e.edited) as edited_sha256, f.f as fingerprint,
  g.f as edited_fingerprint, x.near as near_edited, y.near as near_next,
  case when left(f.f, 64) <> left(g.f, 64) then x.edit_start end as edit_start,
  case when left(f.f, 64) <> left(g.f, 64) then x.edit_end end as edit_end
from edited e join tree f on f.t = e.text join tree g on g.t = e.edited join tree h on h.t = e.next
  join likeness x on x.a = f.f and x.b = g.f join likeness y on y.a = f.f and y.b = h.f
"""
