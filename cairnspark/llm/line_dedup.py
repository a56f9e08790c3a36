"""Line dedup by a log-template tree, in DataFrame functions only.

A line's leaf in the tree is its token count and its first ``depth`` tokens,
tokens with a digit generalised to ``<*>``.  Within a leaf that enough texts
share, a token position keeps the tokens that enough lines have there and
generalises the rest; the generalised line is its template.  A template that
at least ``min_support`` different texts hold recurs, and its lines are
dropped from every document.

Recurrence counts different texts: equal copies of a document count once, so a
document does not lose its lines because it was copied (duplicate removal
handles copies).  Copies that differ are different texts.

Texts are not shuffled: each scan emits narrow rows of its lines, and the last
scan rebuilds the templates of its lines and looks them up.  Those tables (the
recurring templates, their leaves and fixed tokens) are constants of the plan
up to ``lookup_bytes`` bytes in all, measured; beyond that the dropped
positions, found in the narrow rows, are joined to the documents by a shuffle
on the text's digest.  Both give the same rows.

Edge cases: a null or empty text has no lines and stays as it is; blank lines
and lines of under ``min_tokens`` tokens are never templates; repeated lines
of one document count once; a document may lose all its lines (text becomes
empty, ``n_lines_kept`` 0); repeated ids are separate rows, each judged by its
own text; an empty table gives an empty result; extra columns pass through,
but one that has the name of an output column is replaced by it.  Lines end at
``\\n``; all others are kept byte for byte.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.shared import constant_set, cut, drop, within

DEPTH = 3
MIN_TOKENS = 3
MIN_SUPPORT = 10
MIN_FIXED = 0.5
BROADCAST_BYTES = 32 << 20
LOOKUP_BYTES = 4 << 20
ANY = "<*>"


class Recurring(NamedTuple):
    """Tables in the shared folder: ``keys(kind, key)`` of the recurring templates (T), their leaves (L) and fixed tokens (C); ``shaped(digest, pos, leaf, template)``."""

    keys: DataFrame
    shaped: DataFrame
    depth: int
    min_tokens: int


def masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(ANY)).otherwise(token)


def lines_of(text: Column) -> Column:
    """Lines as their tokens with one space between: tokens stand between spaces, tabs and carriage returns."""
    plain = F.replace(F.replace(text, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.transform(F.split(plain, "\n"), lambda x: F.trim(F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, "  +", " ")).otherwise(x)))


def tokens(line: Column) -> Column:
    return F.split(line, " ")


def n_tokens(line: Column) -> Column:
    return F.when(line == "", 0).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def leaf_of(line: Column, depth: int) -> Column:
    head = F.transform(F.split(F.substring_index(line, " ", depth), " "), masked)
    return F.concat_ws(" ", n_tokens(line).cast("string"), head)


def cell_of(leaf: Column, at: Column, token: Column) -> Column:
    return F.concat_ws(" ", leaf, at.cast("string"), token)


def template_of(shape: Column) -> Column:
    return F.array_join(F.transform(F.array(shape), lambda g: F.concat_ws(" ", F.size(g).cast("string"), g)), "")


def shape_of(toks: Column, leaf: Column, depth: int, fixed) -> Column:
    """Masked tokens with those generalised that are not fixed at their position; ``fixed`` tells by the cell."""
    return F.transform(toks, lambda t, i: F.when((i < depth) | fixed(cell_of(leaf, i, t)), t).otherwise(F.lit(ANY)))


def line_table(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """(digest, pos, line, leaf): the lines that can be templates, of each row; the digest is the text's MD5.

    The digest is made below the generator, once for a text; the lines are
    made in it, where Spark infers no filters that would make them again.  A
    leaf needs no tokens but its first.
    """
    d = docs.where(F.col("text").isNotNull()).select(F.unhex(F.md5("text")).alias("digest"), "text")
    d = d.select("digest", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).where(n_tokens(F.col("line")) >= min_tokens)
    return d.withColumn("leaf", leaf_of(F.col("line"), depth))


def recurring(
    docs: DataFrame,
    depth: int = DEPTH,
    min_tokens: int = MIN_TOKENS,
    min_support: int = MIN_SUPPORT,
    min_fixed: float = MIN_FIXED,
    broadcast_bytes: int = BROADCAST_BYTES,
    lookup_bytes: int = LOOKUP_BYTES,
) -> Recurring:
    """The templates that recur in ``docs(text)``, and where.

    Only leaf keys are counted over all lines; whole lines go on only from
    leaves that enough texts share, once for each different text.  Counts are
    partial aggregates, so a leaf or template with a third of all rows is no
    hot task.  Leaves are broadcast up to ``broadcast_bytes``, fixed tokens are
    constants up to ``lookup_bytes``, measured; beyond, the same by a shuffle:
    of lines by leaf, which adaptive execution can split, and of tokens by
    leaf, position and token, which no line crowds.
    """
    lines = line_table(docs.select("text"), depth, min_tokens)
    hot = cut(lines.groupBy("leaf", "digest").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("c")).where(F.col("c") >= min_support).select("leaf"), "leaves")
    few = within(hot, "leaf", broadcast_bytes)
    in_hot = lines.join(F.broadcast(hot) if few else hot, "leaf", "left_semi")
    in_hot = in_hot.select("digest", "pos", "leaf", "line").groupBy("digest", "pos").agg(F.first("leaf").alias("leaf"), F.first("line").alias("line"))
    in_hot = cut(in_hot.select("digest", "pos", "leaf", F.transform(tokens(F.col("line")), masked).alias("toks")), "lines")
    cells = in_hot.select("leaf", F.posexplode("toks").alias("at", "tok")).where(F.col("at") >= depth)
    common = cut(cells.groupBy("leaf", "at", "tok").agg(F.count("*").alias("c")).where(F.col("c") >= min_support).select("leaf", cell_of(F.col("leaf"), F.col("at"), F.col("tok")).alias("key")), "common")
    if within(common, "key", lookup_bytes):
        shaped = in_hot.select("digest", "pos", "leaf", F.explode(F.array(shape_of(F.col("toks"), F.col("leaf"), depth, constant_set(common)))).alias("g"))
    else:
        known = in_hot.select("digest", "pos", "leaf", F.posexplode("toks").alias("at", "tok")).withColumn("key", cell_of(F.col("leaf"), F.col("at"), F.col("tok")))
        known = known.join(common.select(F.col("key").alias("k2")), F.col("key") == F.col("k2"), "left")
        token = F.when((F.col("at") < depth) | F.col("k2").isNotNull(), F.col("tok")).otherwise(F.lit(ANY))
        shaped = known.groupBy("digest", "pos").agg(F.first("leaf").alias("leaf"), F.array_sort(F.collect_list(F.struct("at", token.alias("t")))).alias("v")).select("digest", "pos", "leaf", F.col("v.t").alias("g"))
    shaped = shaped.where(F.size(F.filter("g", lambda t: t != ANY)) >= min_fixed * F.size("g"))
    shaped = cut(shaped.select("digest", "pos", "leaf", template_of(F.col("g")).alias("template")), "templates")
    found = shaped.groupBy("template", "leaf", "digest").agg(F.lit(1).alias("one")).groupBy("template", "leaf").agg(F.count("*").alias("c")).where(F.col("c") >= min_support)
    found = cut(found.select("template", "leaf"), "recurring")
    leaves = found.select("leaf").distinct()
    keys = found.select(F.lit("T").alias("kind"), F.col("template").alias("key")).union(leaves.select(F.lit("L"), "leaf")).union(common.join(leaves, "leaf", "left_semi").select(F.lit("C"), "key"))
    keys = cut(keys, "keys")
    for used in (hot, in_hot, common, found):
        drop(used)
    return Recurring(keys, shaped, depth, min_tokens)


def hits(found: Recurring) -> DataFrame:
    """(digest, pos, template) of the lines to drop, once for each different text."""
    kept = found.keys.where("kind = 'T'").select(F.col("key").alias("template"))
    return found.shaped.join(kept, "template", "left_semi").select("digest", "pos", "template")


def drop_lines(docs: DataFrame, found: Recurring, lookup_bytes: int = LOOKUP_BYTES, names: tuple[str, str, str] = ("kept", "n_lines", "n_lines_kept")) -> DataFrame:
    """``docs`` without those lines: the kept text, the number of lines and of kept lines, added under ``names``."""
    lines = F.split("text", "\n")
    if within(found.keys, "key", lookup_bytes):
        is_leaf, is_fixed, is_template = (constant_set(found.keys.where(F.col("kind") == k)) for k in "LCT")

        def recurs(line: Column) -> Column:
            shape = lambda leaf: shape_of(F.transform(tokens(line), masked), leaf, found.depth, is_fixed)
            return F.exists(F.array(leaf_of(line, found.depth)), lambda leaf: is_leaf(leaf) & is_template(template_of(shape(leaf))))

        # lines_of has the same lines, byte for byte but for the spaces
        out = docs.withColumn("_cairn_lines", F.arrays_zip(lines.alias("x"), F.transform(lines_of(F.col("text")), recurs).alias("gone")))
        out = out.withColumn("_cairn_keep", F.filter("_cairn_lines", lambda x: ~x.gone))
        kept = F.array_join(F.col("_cairn_keep.x"), "\n")
    else:
        gone = hits(found).groupBy(F.col("digest").alias("_cairn_digest")).agg(F.collect_set("pos").alias("_cairn_gone"))
        out = docs.join(gone, F.unhex(F.md5(docs["text"])) == F.col("_cairn_digest"), "left").drop("_cairn_digest").withColumn("_cairn_lines", lines)
        out = out.withColumn("_cairn_keep", F.when(F.col("_cairn_gone").isNull(), F.col("_cairn_lines")).otherwise(F.filter("_cairn_lines", lambda x, i: ~F.array_contains("_cairn_gone", i)))).drop("_cairn_gone")
        kept = F.array_join("_cairn_keep", "\n")
    counts = [F.when(F.col("text").isNull(), 0).otherwise(F.size(c)).cast("long") for c in ("_cairn_lines", "_cairn_keep")]
    whole = F.size("_cairn_keep") == F.size("_cairn_lines")
    made = [F.when(whole, F.col("text")).otherwise(kept), *counts]
    # out of a generator, so that a filter on them does not make them again
    one = F.explode(F.array(F.struct(*[c.alias(n) for c, n in zip(made, names, strict=True)]))).alias("_cairn_out")
    out = out.select(*[c for c in docs.columns if c not in names], one)
    return out.select(*[F.col(f"_cairn_out.{c}").alias(c) if c in names else F.col(c) for c in docs.columns], *[F.col(f"_cairn_out.{c}") for c in names if c not in docs.columns])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_lines(docs, recurring(docs))
    return out.select("doc_id", "n_lines", "n_lines_kept", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = f"""
WITH d AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
ex AS (SELECT text, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
tk AS (SELECT text, pos, list_transform(list_filter(string_split_regex(line, '[ \\t\\r]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{ANY}' ELSE t END) AS toks FROM ex),
li AS (SELECT *, concat_ws(' ', len(toks)::VARCHAR, array_to_string(toks[1:{DEPTH}], ' ')) AS leaf FROM tk WHERE len(toks) >= {MIN_TOKENS}),
hot AS (SELECT leaf FROM li GROUP BY leaf HAVING count(DISTINCT text) >= {MIN_SUPPORT}),
ih AS (SELECT li.* FROM li SEMI JOIN hot USING (leaf)),
ce AS (SELECT leaf, unnest(range(len(toks))) AS ix, unnest(toks) AS tok FROM ih),
co AS (SELECT leaf, list(ix::VARCHAR || ' ' || tok) AS fixed FROM (SELECT leaf, ix, tok FROM ce WHERE ix >= {DEPTH} GROUP BY ALL HAVING count(*) >= {MIN_SUPPORT}) GROUP BY leaf),
sh AS (SELECT text, pos, list_transform(toks, lambda t, i: CASE WHEN i <= {DEPTH} OR list_contains(coalesce(fixed, []), (i - 1)::VARCHAR || ' ' || t) THEN t ELSE '{ANY}' END) AS g
  FROM ih LEFT JOIN co USING (leaf)),
tp AS (SELECT text, pos, len(g)::VARCHAR || ' ' || array_to_string(g, ' ') AS template FROM sh
  WHERE len(list_filter(g, lambda t: t <> '{ANY}')) >= {MIN_FIXED} * len(g)),
ke AS (SELECT template FROM tp GROUP BY template HAVING count(DISTINCT text) >= {MIN_SUPPORT}),
gone AS (SELECT text, list(pos) AS gone FROM tp SEMI JOIN ke USING (template) GROUP BY text),
raw AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
fi AS (SELECT raw.doc_id, raw.text, ls, list_filter(ls, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)) AS keep FROM raw LEFT JOIN gone ON raw.text = gone.text)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines,
  CASE WHEN text IS NULL THEN 0 ELSE len(keep) END::BIGINT AS n_lines_kept,
  sha256(array_to_string(keep, chr(10))) AS kept_sha256 FROM fi
"""
