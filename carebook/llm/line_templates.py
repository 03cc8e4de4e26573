"""Line deduplication by a log-template tree, in DataFrame operations only.

A line's path in the tree is its token count and its leading tokens, with
tokens that hold a digit read as the variable ``<*>``. Each leaf has a template:
at every position the token that more than half of the leaf's distinct lines
have there, or a variable where there is none. These are shares of the leaf, so a
field is variable whether its values are new in every line or come from a small
pool, in a small corpus or a large one. A line belongs to its leaf's template if
it has the template's token in at least ``similarity`` of its positions. Any other
line is a template of its own: with digits masked if its other tokens are
``similarity`` of it or more, else as it is. A template that occurs in two
documents or more recurs: its lines stay in the first of these documents and are
dropped in the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import quoted, stored, text_key
from carebook.operators.broadcast import bounded_broadcast

VARIABLE = "<*>"
DEPTH = 3
SIMILARITY = 0.8
MAX_LISTED = 1_000_000
MAX_TEMPLATES = 20_000  # leaf templates that are broadcast, each as long as its lines; beyond they are joined


def masked(line: Column) -> Column:
    """``line`` with each space-delimited token that holds an ASCII digit as ``<*>``."""
    token = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, token, VARIABLE)).otherwise(line)


def _document(doc_id: Column, key: Column) -> Column:
    """A document's place: by doc_id (nulls last), then by the hash of its text."""
    return F.struct(doc_id.isNull().alias("last"), doc_id.alias("doc_id"), key.alias("text_key"))


def _fixed(text: Column, tokens: Column) -> Column:
    """How many of a masked line's tokens are not variable."""
    return tokens - (F.length(text) - F.length(F.replace(text, F.lit(VARIABLE), F.lit("")))) / len(VARIABLE)


def _lines(docs: DataFrame, depth: int, similarity: float) -> DataFrame:
    """Every line that is not blank, with its leaf, its masked text and whether enough of it is fixed for a template.

    Lines of which too little is fixed have leaves of their own.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"),
                       F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    rows = rows.where(F.trim("line") != "").withColumn("masked", masked(F.col("line")))
    tokens = F.length("masked") - F.length(F.translate("masked", " ", "")) + 1
    spelled = F.when(F.col("fixed"), F.col("masked")).otherwise(F.col("line"))
    return (rows.withColumn("tokens", tokens).withColumn("fixed", _fixed(F.col("masked"), F.col("tokens")) / F.col("tokens") >= similarity)
            .withColumn("leaf", F.xxhash64("fixed", "tokens", F.substring_index("masked", " ", depth)))
            .withColumn("template", F.xxhash64("leaf", spelled)).drop("line"))


def _first_and_last(doc: Column) -> list[Column]:
    return [F.min(doc).alias("first"), F.max(doc).alias("last")]


def _leaf_templates(in_leaf: DataFrame) -> DataFrame:
    """(leaf, spelled): at each position the hash of the token that most of the leaf's distinct lines have, or null."""
    counted = (in_leaf.select("leaf", F.posexplode("words").alias("at", "word")).groupBy("leaf", "at", "word").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("leaf", "at").agg(F.max(F.struct("n", "word")).alias("most"), F.sum("n").alias("lines")))
    fixed = F.when((2 * F.col("most.n") > F.col("lines")) & (F.col("most.word") != F.xxhash64(F.lit(VARIABLE))), F.col("most.word"))
    return (counted.select("leaf", F.struct("at", fixed.alias("word")).alias("place")).groupBy("leaf")
            .agg(F.transform(F.array_sort(F.collect_list("place")), lambda p: p["word"]).alias("spelled")))


def dropped_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, drops): of each document that loses lines, their numbers, from 0.

    Rows with the same doc_id and text are one document.
    """
    lines = _lines(docs, depth, similarity)
    places = stored(lines.select("doc_id", "text_key", "line_no", "tokens", "leaf", "template", "fixed"), "lines")
    doc = _document(F.col("doc_id"), F.col("text_key"))
    alike = stored(places.groupBy("template").agg(F.min("leaf").alias("leaf"), F.min("tokens").alias("tokens"), F.min("fixed").alias("fixed"),
                                                 *_first_and_last(doc)), "masked-lines")

    # Leaves in which lines of several documents differ; with fewer tokens one
    # variable is already too many.
    mixed = (alike.where(F.col("fixed") & ((F.col("tokens") - 1) / F.col("tokens") >= similarity)).groupBy("leaf")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("first").alias("a"), F.max("last").alias("z"))
             .where((F.col("_n") > 1) & (F.col("a") != F.col("z"))).select("leaf"))
    mixed = bounded_broadcast(stored(mixed, "mixed-leaves"), MAX_LISTED)
    in_leaf = (lines.join(mixed, "leaf", "left_semi").groupBy("leaf", "template").agg(F.min("masked").alias("masked"))
               .select("leaf", "template", F.transform(F.split("masked", " ", -1), lambda w: F.xxhash64(w)).alias("words")))
    in_leaf = stored(in_leaf, "leaf-lines")
    templates = stored(_leaf_templates(in_leaf), "leaf-templates")
    agreed = F.size(F.filter(F.zip_with("words", "spelled", lambda a, b: a == b), lambda same: same))
    general = (in_leaf.join(bounded_broadcast(templates, MAX_TEMPLATES), "leaf").where(agreed / F.size("words") >= similarity)
               .select("template", F.xxhash64("leaf", F.lit(VARIABLE)).alias("_general")))
    named = alike.join(general, "template", "left").withColumn("name", F.coalesce("_general", "template"))
    recurring = (named.groupBy("name").agg(F.min("first").alias("keeper"), F.max("last").alias("z"))
                 .where(F.col("keeper") != F.col("z")).select("name", "keeper"))
    listed = stored(named.where(F.col("_general").isNotNull() | (F.col("first") != F.col("last")))
                    .join(recurring, "name").select("template", "keeper"), "recurring")
    return (places.join(bounded_broadcast(listed, MAX_LISTED), "template").where(doc != F.col("keeper"))
            .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("drops")))


def deduplicated(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``text`` without recurring
    lines, ``lines`` and ``lines_dropped`` of every row of ``docs``.

    Lines end at ``\\n``; blank lines are no templates and stay. What stays is
    joined by ``\\n`` again, so a text without recurring lines is unchanged. A
    null text stays null with 0 lines; an empty text is one blank line. Of rows
    that share doc_id and text each is treated alike. The first document is the
    one with the smallest doc_id (nulls last). An empty table gives no rows.
    """
    drops = dropped_lines(docs, depth, similarity).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "drops")
    text = F.col("text").cast("string")
    # The lines are split before the join, so that they are a column, not an
    # expression that is evaluated again for each line.
    split = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns if c != "text"]).alias("row"),
                        F.col("doc_id").cast("long").alias("_doc_id"), text_key(text).alias("_text_key"), F.split(text, "\n").alias("_lines"))
    joined = split.join(drops, F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.col("_lines")).otherwise(F.transform(stay, lambda i: F.col("_lines")[i]))
    return joined.select("row", F.array_join(kept, "\n").alias("text"), _size("_lines").alias("lines"), _size("drops").alias("lines_dropped"))


def without_recurring_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with its own columns, ``text`` without recurring lines (see ``deduplicated``)."""
    return as_documents(deduplicated(docs, depth, similarity), docs.columns)


def as_documents(found: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``deduplicated`` under the columns of its input."""
    return found.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def _size(column: str) -> Column:
    return F.when(F.col(column).isNull(), 0).otherwise(F.size(column)).cast("long")


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line_no, s[i] AS line
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))
),
t AS (
  SELECT doc_id, line_no, line,
         list_transform(string_split(line, ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tok
  FROM l WHERE trim(line, ' ') <> ''
),
m AS (
  SELECT doc_id, line_no, array_to_string(tok, ' ') AS masked, len(tok) AS n, array_to_string(tok[1:3], ' ') AS lead, line,
         (len(tok) - (length(array_to_string(tok, ' ')) - length(replace(array_to_string(tok, ' '), '<*>', ''))) / 3) / len(tok) >= 0.8 AS fixed
  FROM t
),
k AS (SELECT *, CASE WHEN fixed THEN masked ELSE line END AS spelled FROM m),
alike AS (SELECT n, lead, fixed, spelled, min(doc_id) AS a, max(doc_id) AS z FROM k GROUP BY ALL),
mixed AS (
  SELECT n, lead FROM alike WHERE fixed AND (n - 1) / n >= 0.8 GROUP BY ALL HAVING count(*) > 1 AND min(a) <> max(z)
),
g AS (
  SELECT n, lead, spelled, unnest(range(1, n + 1)) AS i, string_split(spelled, ' ') AS tok
  FROM alike SEMI JOIN mixed USING (n, lead) WHERE fixed
),
p AS (SELECT n, lead, spelled, i, tok[i] AS token FROM g),
c AS (
  SELECT n, lead, i, token, count(*) AS lines, sum(count(*)) OVER (PARTITION BY n, lead, i) AS of_leaf FROM p GROUP BY n, lead, i, token
),
general AS (
  SELECT n, lead, spelled FROM p JOIN c USING (n, lead, i, token) WHERE 2 * lines > of_leaf AND token <> '<*>'
  GROUP BY n, lead, spelled HAVING count(*) / n >= 0.8
),
named AS (
  SELECT alike.*, CASE WHEN g.n IS NULL THEN spelled ELSE '' END AS name
  FROM alike LEFT JOIN (SELECT *, true AS fixed FROM general) g USING (n, lead, fixed, spelled)
),
recurring AS (SELECT n, lead, fixed, name, min(a) AS keeper FROM named GROUP BY ALL HAVING min(a) <> max(z)),
gone AS (
  SELECT DISTINCT m.doc_id, m.line_no
  FROM k AS m JOIN named USING (n, lead, fixed, spelled) JOIN recurring USING (n, lead, fixed, name)
  WHERE m.doc_id <> keeper
),
kept AS (
  SELECT l.doc_id, string_agg(CASE WHEN gone.doc_id IS NULL THEN l.line END, chr(10) ORDER BY l.line_no) AS text,
         count(*) AS lines, count(gone.doc_id) AS lines_dropped
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.line_no = gone.line_no GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
       coalesce(kept.lines, 0) AS lines, coalesce(kept.lines_dropped, 0) AS lines_dropped
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
