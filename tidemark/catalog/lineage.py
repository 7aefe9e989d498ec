"""Column lineage from view definitions.

A select list is cut at the commas outside all brackets, so function calls with
several arguments stay whole. Every qualified column that an item mentions is an
edge of its own. Text in quotes is not told apart from code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = r"[A-Za-z_][A-Za-z0-9_]*"
#: A column after the name of its table, which may hold dots itself.
REFERENCE = rf"(?<![A-Za-z0-9_.]){NAME}(?:[.-]{NAME})*\.{NAME}(?![A-Za-z0-9_.(])"

# The kinds of an expression, the first that fits.
KINDS = [("cast", r"(?i)^cast\s*\("), ("aggregate", "[+*/-]"), ("rename", "[.]")]


def transformation_type(expr: str | Column) -> Column:
    """A cast, arithmetic of any sign, a qualified column, or else a direct one."""
    text = F.col(expr) if isinstance(expr, str) else expr
    return F.coalesce(*[F.when(text.rlike(sign), F.lit(kind)) for kind, sign in KINDS], F.lit("direct"))


def _nesting(text: Column) -> Column:
    """Opening brackets less closing ones."""
    return F.length(F.replace(text, F.lit(")"))) - F.length(F.replace(text, F.lit("(")))


def top_level_items(select_list: Column) -> Column:
    """The items of a select list. Pieces between commas are joined again while a bracket is open."""
    start = F.struct(F.lit(0).alias("open"), F.array().cast("array<string>").alias("items"))

    def add(acc: Column, piece: Column) -> Column:
        done = F.slice(acc["items"], 1, F.greatest(F.size(acc["items"]) - 1, F.lit(0)))
        longer = F.concat(done, F.array(F.concat_ws(",", F.element_at(acc["items"], -1), piece)))
        items = F.when(acc["open"] > 0, longer).otherwise(F.concat(acc["items"], F.array(piece)))
        return F.struct((acc["open"] + _nesting(piece)).alias("open"), items.alias("items"))

    return F.aggregate(F.split(select_list, ","), start, add, lambda acc: acc["items"])


def _clauses(sql: Column) -> tuple[Column, Column]:
    """The first select list and the array of sources after FROM or JOIN."""
    body = F.get(F.split(sql, r"(?i)\bselect\s", 2), 1)
    parts = F.split(body, r"(?i)\b(?:from|join)\s+")
    named = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.regexp_extract(p, r"^`?([\w.-]+)", 1))
    # Never null: a test for it would move the search into the scan of the views.
    return F.get(parts, 0), F.coalesce(F.array_distinct(F.filter(named, lambda n: n != "")), F.array().cast("array<string>"))


def lineage_edges(views: DataFrame) -> DataFrame:
    """An edge for each aliased select item and each column of a source table that it mentions.

    ``views`` has target_table and view_sql. A view is little to read and much to
    take apart, so the views are spread over all tasks first.
    """
    tasks = int(views.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    views = views.repartition(tasks, "target_table", "view_sql")
    select_list, sources = _clauses(F.col("view_sql"))
    items = views.select("target_table", sources.alias("sources"), F.explode(top_level_items(select_list)).alias("item"))
    # The alias is the last word; what stands before it, less AS, is the expression.
    alias = F.regexp_extract("item", rf"\s({NAME})\s*$", 1)
    before = F.trim(F.regexp_replace("item", rf"(?i)(?:\s+as)?\s+{NAME}\s*$", ""))
    named = items.select("target_table", "sources", alias.alias("target_column"), before.alias("expr")).where("target_column <> ''")
    mentions = F.array_distinct(F.regexp_extract_all("expr", F.lit(REFERENCE), F.lit(0)))
    found = named.select("*", F.explode(mentions).alias("mention"))
    column = F.substring_index("mention", ".", -1)
    table = F.expr("left(mention, length(mention) - length(substring_index(mention, '.', -1)) - 1)")
    return found.where(F.array_contains("sources", table)).select(
        table.alias("source_table"), column.alias("source_column"), "target_table", "target_column", transformation_type("expr").alias("transformation")
    )
