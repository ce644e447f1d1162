"""Conversations out of reply trees, in a template that can be read back."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.shared import staged

#: The template, fixed: a turn is OPEN, the role, BETWEEN, the text, CLOSE.
OPEN, BETWEEN, CLOSE = "### ", ": ", " </turn>\n"
#: The characters that template strings need, and the escapes that stand for them inside texts.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))

LOSS = "array<struct<start:int,length:int>>"


def escaped(text: Column) -> Column:
    """``text`` without any character that the template's marks begin with."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The reverse of ``escaped``: each backslash there begins an escape, so the order does not matter."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Root-to-leaf paths of reply trees: ``tree``, ``leaf``, ``mean`` score and ``path`` (node ids from the root).

    ``messages`` has ``tree``, ``node``, ``parent`` and ``score``. Self-joins of
    the links 2^k steps up give those 2^(k+1) steps up, for the messages that
    lie so deep; from the leaves, the links are then followed from the longest
    to the shortest, which meets each ancestor once. With ``top``, the branches
    of a tree are ranked by their mean score (nulls as 0), ties by the leaf's id,
    and that many with their ``rank`` are kept. A message whose parent is null or missing is a root;
    messages on a cycle or below one reach no root and are on no path. Null trees or
    nodes are left out; of a repeated node the smallest parent and score count.
    """
    clean = messages.where("tree IS NOT NULL AND node IS NOT NULL").groupBy("tree", "node").agg(
        F.min("parent").alias("parent"), F.coalesce(F.min("score"), F.lit(0.0)).cast("double").alias("score")
    )
    clean = staged(clean, "messages")
    above = clean.select("tree", F.col("node").alias("up"), F.col("score").alias("up_score"))
    links = [staged(clean.select("tree", "node", F.col("parent").alias("up")).join(above, ["tree", "up"]), "links")]
    largest = clean.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    while 2 ** (len(links) - 1) < largest and not links[-1].isEmpty():
        above = links[-1].select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("up_score").alias("_score"))
        further = links[-1].drop("up_score").join(above, ["tree", "up"])
        links.append(staged(further.select("tree", "node", F.col("_up").alias("up"), F.col("_score").alias("up_score")), "links"))
    inner = links[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = clean.join(inner, ["tree", "node"], "left_anti")
    # A link of as many steps as the largest tree has messages runs on a cycle.
    leaves = leaves.join(links.pop().select("tree", "node"), ["tree", "node"], "left_anti")
    steps = staged(leaves.select("tree", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("distance"), "node", "score"), "steps")
    for k in reversed(range(len(links))):
        reached = steps.drop("score").join(links[k], ["tree", "node"]).select(
            "tree", "leaf", (F.col("distance") + 2**k).alias("distance"), F.col("up").alias("node"), F.col("up_score").alias("score")
        )
        steps = steps.unionByName(staged(reached, "steps"))
    paths = steps.groupBy("tree", "leaf").agg(
        F.avg("score").alias("mean"), F.sort_array(F.collect_list(F.struct("distance", "node")), asc=False).getField("node").alias("path")
    )
    if top is None:
        return paths
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")  # ids and scores meet to be ranked, no paths
    means = steps.groupBy("tree", "leaf").agg(F.avg("score").alias("mean"))
    best = means.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(paths.drop("mean"), ["tree", "leaf"]).select("tree", "leaf", "mean", "rank", "path")


def formatted(paths: DataFrame, texts: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``tree``, ``leaf``, ``formatted`` and ``loss`` (start and length in code points), a row per path.

    ``texts`` has ``tree``, ``node``, ``role`` and ``text``, nulls as empty.
    The loss mask covers the text of each ``trained_role`` turn, without marks.
    """
    rows = paths.select("tree", "leaf", F.posexplode("path").alias("place", "node")).join(texts, ["tree", "node"])
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = rows.select("tree", "leaf", "place", role.alias("role"), escaped(role).alias("head"), escaped(text).alias("body"))
    before = Window.partitionBy("tree", "leaf").orderBy("place")
    marks = len(OPEN) + len(BETWEEN) + len(CLOSE)
    rows = rows.withColumn("stop", F.sum(F.length("head") + F.length("body") + marks).over(before) - len(CLOSE))
    turn = F.struct(
        "place",
        F.concat(F.lit(OPEN), "head", F.lit(BETWEEN), "body", F.lit(CLOSE)).alias("turn"),
        (F.col("role") == trained_role).alias("trained"),
        (F.col("stop") - F.length("body")).cast("int").alias("start"),
        F.length("body").alias("length"),
    )
    turns = rows.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    trained = F.filter("turns", lambda t: t.trained)
    return turns.select(
        "tree",
        "leaf",
        F.array_join("turns.turn", "").alias("formatted"),
        F.transform(trained, lambda t: F.struct(t.start.alias("start"), t.length.alias("length"))).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role`` and ``text``, unescaped."""
    parts = F.split(formatted, CLOSE)  # no escaped text holds the mark, so the split is exact
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part):
        head = F.substring_index(part, BETWEEN, 1)
        body = F.substr(part, F.length(head) + len(BETWEEN) + 1)
        return F.struct(unescaped(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(loss, lambda s: unescaped(F.substr(formatted, s.start + 1, s.length)))


def conversation_messages(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id``, ``turn``, ``role``, ``text``) as reply trees of one branch each.

    A row answers the one before it by ``turn`` (nulls first); rows of the same
    turn follow by role and text, so repeated rows are all kept. A null
    ``conv_id`` is a conversation of its own. ``tree`` carries ``conv_id``.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    tree = F.struct(F.col("conv_id").isNull().alias("unknown"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"))
    node = F.row_number().over(order)
    return turns.select(
        tree.alias("tree"), node.alias("node"), F.when(node > 1, node - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"
    )


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss`` of every conversation."""
    messages = staged(conversation_messages(turns), "conversation")
    paths = branches(messages.select("tree", "node", "parent", "score"))
    done = formatted(paths, messages.select("tree", "node", "role", "text"), trained_role)
    conv_id = F.when(~F.col("tree.unknown"), F.col("tree.conv_id"))
    return done.select(conv_id.alias("conv_id"), "formatted", "loss")
