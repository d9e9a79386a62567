"""Formatting reply trees as conversations.

Messages form trees by (tree, id, parent). Iterative self-joins enumerate the paths from root to leaf: each round doubles the length of the
ancestor links known, so a thread of n replies takes log2 n joins. Branches are ranked by score, and each chosen path becomes one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import cut, stored

#: Marks of the template. Fixed values.
OPEN, CLOSE = "[INST]", "[/INST]"
START, END = "<s>", "</s>"
SYSTEM_OPEN, SYSTEM_CLOSE = "<<SYS>>", "<</SYS>>"
ASSISTANT_OPEN = "[ASSISTANT]"
#: Any other role: its name stands, escaped, between these.
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
_MARKS = {"user": (START + OPEN, CLOSE), "assistant": (ASSISTANT_OPEN, END), "system": (SYSTEM_OPEN, SYSTEM_CLOSE)}
_ESCAPE = "\\"


def escape(text: str) -> str:
    """Each mark starts with < or [ and each of these gets a backslash, as has each backslash: no mark is left inside a text."""
    return text.replace(_ESCAPE, _ESCAPE * 2).replace("<", _ESCAPE + "<").replace("[", _ESCAPE + "[")


def unescape(text: str) -> str:
    out, at = [], 0
    while (k := text.find(_ESCAPE, at)) >= 0:
        out += [text[at:k], text[k + 1 : k + 2]]
        at = k + 2
    return "".join([*out, text[at:]])


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns, and the spans of it that assistants wrote: the loss mask, escapes included."""
    out, spans, at = [], [], 0
    for role, text in turns:
        own = escape(text)
        left, right = _MARKS.get(role) or (ROLE_OPEN + escape(role) + ROLE_CLOSE, END)
        if role == "assistant":
            spans.append((at + len(left), at + len(left) + len(own)))
        out += [left, own, right]
        at += len(left) + len(own) + len(right)
    return "".join(out), spans


def parse_turns(text: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text: the inverse of format_turns()."""

    def until(mark: str, at: int) -> tuple[str, int]:
        start = at
        while True:
            k = text.index(mark, at)
            back = k
            while back > start and text[back - 1] == _ESCAPE:
                back -= 1
            if (k - back) % 2 == 0:
                return unescape(text[start:k]), k + len(mark)
            at = k + 1

    at = 0
    while at < len(text):
        for role, (left, right) in [*_MARKS.items(), ("", (ROLE_OPEN, END))]:
            if text.startswith(left, at):
                at += len(left)
                if not role:
                    role, at = until(ROLE_CLOSE, at)
                said, at = until(right, at)
                yield role, said
                break
        else:
            raise ValueError("not a formatted conversation")


def one_each(messages: DataFrame) -> DataFrame:
    """Of the messages that share an id in a tree the least by parent, score, role and text, nulls first; none with a null id."""
    rest = [c for c in ("parent", "score", "role", "text") if c in messages.columns]
    return messages.where("id IS NOT NULL").groupBy("tree", "id").agg(F.min(F.struct(*rest)).alias("m")).select("tree", "id", "m.*")


def paths(messages: DataFrame) -> DataFrame:
    """messages(tree, id, parent, score) -> (tree, leaf, depth, id, score): the messages on the way from each leaf to its root.

    ids are unique in a tree (one_each() makes them so) and not null. A message whose parent is null or unknown is a root; messages on a cycle belong
    to no leaf and are left out. No messages, no paths. Round k
    joins each message with the ancestor 2^k levels up, keeping only pointers; then a leaf's path is walked by halving distances.
    """
    own = messages.select("tree", "id", "parent")
    known = own.select("tree", F.col("id").alias("parent")).distinct()
    links = cut(own.where("parent IS NOT NULL").join(known, ["tree", "parent"], "left_semi").select("tree", "id", "parent"))
    levels = [links]
    # No path is longer than its tree's links; only cycles have ancestors further up.
    longest = links.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while 1 << len(levels) <= longest:
        last = levels[-1]
        up = last.select("tree", F.col("id").alias("parent"), F.col("parent").alias("above"))
        further = cut(last.join(up, ["tree", "parent"]).select("tree", "id", F.col("above").alias("parent")))
        if further.isEmpty():
            break
        levels.append(further)
    leaves = own.join(links.select("tree", F.col("parent").alias("id")).distinct(), ["tree", "id"], "left_anti")
    found = leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(levels))):
        step = levels[k].select("tree", "id", F.col("parent").alias("_to"))
        both = F.array(F.struct("id", "up"), F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("id"), (F.col("up") + F.lit(1 << k)).alias("up"))))
        # One branch of the plan a level: a union of the two would double it each time.
        found = found.join(step, ["tree", "id"], "left").select("tree", "leaf", F.explode(both).alias("x")).where("x IS NOT NULL").select("tree", "leaf", "x.id", "x.up")
    length = Window.partitionBy("tree", "leaf")
    depth = F.max("up").over(length) - F.col("up")
    return found.withColumn("depth", depth).join(messages.select("tree", "id", "score"), ["tree", "id"]).select("tree", "leaf", "depth", "id", "score")


def best_paths(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """paths() with (path_score, rank): leaves of a tree ranked by their path's mean score, null scores counting as 0, ties by leaf; ``keep`` of each
    tree, or all. ids are as in paths()."""
    found = cut(paths(messages))
    scored = found.groupBy("tree", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("path_score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf")))
    if keep is not None:
        ranked = ranked.where(F.col("rank") <= keep)
    return found.join(ranked, ["tree", "leaf"])


def formatted(messages: DataFrame, keep: int | None = None, unique: bool = False) -> DataFrame:
    """messages(tree, id, parent, score, role, text) -> (tree, leaf, rank, text, loss_spans): one row for each chosen path.

    Null texts and roles count as empty. Unless ids are known to be ``unique``, as threads() makes them, one message of each id is taken by
    one_each(). A path's text is one row by its nature; tasks hold one path at a time.

    The messages are stored once: paths are found over their ids and scores alone, and texts joined last.
    """
    # Null trees are one tree: in structs, nulls are equal in joins too.
    messages = messages.select(F.struct("tree").alias("tree"), "id", "parent", "score", "role", "text")
    messages = stored(messages if unique else one_each(messages), "messages")
    turns = best_paths(messages.select("tree", "id", "parent", "score"), keep).join(messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), ["tree", "id"])
    gathered = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "id", "role", "text"))).alias("turns")).select("tree.tree", "leaf", "rank", "turns")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for b in batches:
            texts, masks = [], []
            for own in b.column("turns").to_pylist():
                text, at = format_turns([(t["role"], t["text"]) for t in own])
                texts.append(text)
                masks.append([{"start": s, "stop": e} for s, e in at])
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("leaf"), b.column("rank"), pa.array(texts, pa.string()), pa.array(masks, spans)], names=["tree", "leaf", "rank", "text", "loss_spans"])

    return gathered.mapInArrow(run, "tree long, leaf long, rank int, text string, loss_spans array<struct<start: long, stop: long>>")


def threads(turns: DataFrame, tree: str = "conv_id", order: str = "turn", nulls: bool = False) -> DataFrame:
    """Linear conversations as messages: each row replies to the one before it by ``order``; ties are broken by role and text.

    Repeated rows are turns of their own, a null ``order`` comes first, and rows whose ``tree`` is null belong to no conversation
    or, with ``nulls``, are one.
    """
    if not nulls:
        turns = turns.where(F.col(tree).isNotNull())
    at = Window.partitionBy(tree).orderBy(order, "role", "text")
    rows = turns.select(F.col(tree).cast("long").alias("tree"), F.row_number().over(at).cast("long").alias("id"), "role", "text")
    return rows.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def read_back(found: DataFrame) -> DataFrame:
    """(tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the formatted texts and their loss spans alone.

    A null tree stays null; a text without turns gives 0 turns and the hashes of nothing; repeated rows stay; no rows give none; columns besides tree, text
    and loss_spans are left behind. A null text or null spans don't come from formatted(), and raise.
    """
    import hashlib

    def run(batches):
        for b in batches:
            out = []
            for tree, text, spans in zip(*(b.column(c).to_pylist() for c in ("tree", "text", "loss_spans")), strict=True):
                turns = list(parse_turns(text))
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
                out.append((tree, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds, strict=True)], names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return found.mapInArrow(run, "tree long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
