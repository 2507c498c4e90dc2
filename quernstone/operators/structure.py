"""Lists into flat sentences, and broken fragments into whole ones. Both look at neighbours in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions.text import FINAL, WS, is_upper, strip

ITEM = rf"^([a-zA-Z])\)[{WS}]*"


def flatten_lists(rows: DataFrame, by: str = "document_id") -> DataFrame:
    """rows (by, pos, text, ...) and, before each header with at least two items, a row with the list as one text.

    Adds is_flat and ord: rows sort by pos, ord. A header ends with a colon; its items follow it at once, each starting
    with a letter and a bracket. Of an item three characters go, whatever they are, as the label stands for them.
    """
    order = Window.partitionBy(by).orderBy("pos")
    t = strip(F.coalesce("text", F.lit("")))
    marked = rows.select(by, "pos", "text").withColumn("_t", t).withColumn("_item", F.col("_t").rlike(ITEM)).withColumn("_colon", F.col("_t").endswith(":"))
    # a run of items takes the island of the row before it; a colon item splits its run for headers inside it
    runs = marked.withColumn("_island", F.sum(F.when(F.col("_item"), 0).otherwise(1)).over(order))
    run = Window.partitionBy(by, "_island").orderBy("pos")
    whole = Window.partitionBy(by, "_island")
    runs = runs.withColumn("_items", F.sum(F.col("_item").cast("int")).over(whole)).withColumn("_left", F.col("_items") - F.coalesce(F.sum(F.col("_item").cast("int")).over(run), F.lit(0)))
    heads = runs.where(F.col("_colon") & (F.col("_left") >= 2)).groupBy(by, "_island").agg(F.min("pos").alias("_head"))
    items = runs.join(heads, [by, "_island"]).where(F.col("_item") & (F.col("pos") > F.col("_head")))
    label = F.lower(F.substring("_t", 1, 1))
    part = F.concat(label, F.lit(")"), strip(F.expr("substring(text, 4)")))
    joined = items.groupBy(by, F.col("_head").alias("pos")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", part.alias("part")))), lambda x: x["part"]), ", ").alias("_list"))
    flat = rows.join(joined, [by, "pos"]).withColumn("text", F.concat(t, F.lit(" "), F.col("_list"))).drop("_list").withColumn("is_flat", F.lit(True)).withColumn("ord", F.lit(0))
    return flat.unionByName(rows.withColumn("is_flat", F.lit(False)).withColumn("ord", F.lit(1)))


def is_heading_or_item(t: Column, min_len: int = 8) -> Column:
    """Whether a text, stripped, starts something of its own: a heading, a numbered line, a list item, or a scrap."""
    return (is_upper(t) & (F.length(t) < 32)) | t.rlike(rf"(?iu)^(Chương|Điều|Mục|Section)[{WS}]+\p{{Nd}}+") | t.rlike(r"^\p{Nd}+[.)]") | t.rlike(rf"^[a-zA-Z]\)[{WS}]+") | (F.length(t) < min_len)


def stitch(rows: DataFrame, by: str = "document_id", min_len: int = 8, max_len: int = 512, max_merge: int = 3) -> DataFrame:
    """(by, pos, text, merged, members): fragments put together, at most max_merge, which is three or less, as long as the first isn't final and the next
    is open; members: their positions.

    rows: (by, pos, text, is_flat), pos unique within by. How far each fragment would reach depends on the next two alone;
    which of them start one is a walk along these reaches.
    """
    order = Window.partitionBy(by).orderBy("pos")
    t = strip(F.coalesce("text", F.lit("")))
    # white space inside the mark's line is none: the text is stripped
    x = rows.select(by, "pos", t.alias("t"), F.coalesce("is_flat", F.lit(False)).alias("flat")).withColumn("final", F.col("t").rlike(FINAL)).withColumn("apart", is_heading_or_item(F.col("t"), min_len) | F.col("flat")).withColumn("n", F.length("t"))
    for d in (1, 2):
        for c in ("t", "final", "apart", "n", "pos"):
            x = x.withColumn(f"{c}{d}", F.lead(c, d).over(order))
    two = ~F.col("flat") & F.col("t1").isNotNull() & ~F.col("final") & ~F.col("apart1") & (F.col("n") + F.col("n1") <= max_len)
    three = two & F.col("t2").isNotNull() & ~F.col("final1") & ~F.col("apart2") & (F.col("n") + 1 + F.col("n1") + F.col("n2") <= max_len)
    x = x.withColumn("reach", F.least(F.when(three, 3).when(two, 2).otherwise(1), F.lit(max(1, max_merge))))
    # starts: cut the sequence behind every fragment that certainly ends a walk, then walk within the short pieces
    certain = (F.col("reach") == 1) & (F.coalesce(F.lag("reach", 1).over(order), F.lit(1)) == 1) & (F.coalesce(F.lag("reach", 2).over(order), F.lit(1)) < 3)
    x = x.withColumn("row", F.row_number().over(order)).withColumn("piece", F.sum(certain.cast("int")).over(order))
    walk = "aggregate(reaches, struct(array() AS starts, 0 AS at, 0 AS next), (s, r) -> struct(if(s.at = s.next, s.starts || array(s.at), s.starts) AS starts, s.at + 1 AS at, if(s.at = s.next, s.next + r, s.next) AS next)).starts"
    pieces = x.groupBy(by, "piece").agg(F.sort_array(F.collect_list(F.struct("row", "reach"))).alias("held")).select(by, F.col("held")[0]["row"].alias("first"), F.expr("transform(held, h -> h.reach)").alias("reaches")).select(by, F.explode(F.expr(walk.replace("array() AS", "cast(array() AS array<int>) AS"))).alias("at"), "first")
    starts = pieces.select(by, (F.col("first") + F.col("at")).alias("row"))
    text = F.when(F.col("reach") == 3, F.concat_ws(" ", "t", "t1", "t2")).when(F.col("reach") == 2, F.concat_ws(" ", "t", "t1")).otherwise(F.col("t"))
    return x.join(starts, [by, "row"]).select(by, "pos", text.alias("text"), F.col("reach").alias("merged"), F.slice(F.array("pos", "pos1", "pos2"), 1, F.col("reach")).alias("members"))
