"""Chat formatting as prefix trees: conversations that share initial turns share their tokens.

A turn is written between marks; control strings inside its text are escaped. A node is a turn after given earlier
turns, named by a chain of digests. Distinct conversations, sorted by their chains, are the trees in depth-first order:
a conversation adds the nodes that the one before it does not have. Each node gets the place of its tokens in its
tree, their positions in the conversation, and the places of its ancestors, which its tokens attend to.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.shared import checkpointed, stored
from comptoir.operators.joins import lookup

#: Marks before and after the text of a role; other roles are named between the ROLE marks.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_MARKS, OTHER_END = ("[ROLE]", "[/ROLE]"), "[/END]"
CONTROLS = ("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/END]")
#: A control string, or one with backslashes after its first letter. No control string can begin inside another.
_CONTROL = r"([<\[])(\\*)(/?s>|/?(?:INST|SYS|ROLE|END)\])"
_ESCAPED = re.compile(r"([<\[])\\(\\*/?(?:s>|(?:INST|SYS|ROLE|END)\]))")
#: The role whose texts are learned.
LEARNED = "assistant"
#: Turns by which conversations are dealt out; conversations that share more stay together.
KEY_TURNS = 64


def escaped(text: Column) -> Column:
    """A backslash more after the first letter of each control string, so that none is left."""
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Trees(NamedTuple):
    """`nodes`: `node, parent, tree, depth, begin, length, position, ancestors, learn_begin, learn_end, ids`.

    `begin` is the place of the node's first token among its tree's tokens, of which it has `length`; `position` is that token's place
    in a conversation. A token attends to the places in `ancestors` (structs `begin, end`), and to its node's from `begin` to
    itself. Tokens from `learn_begin` to `learn_end`, counted in the node, are under the loss mask. `ids` are
    little-endian unsigned 32-bit. Ends are exclusive.

    `conversations`: `conv_id, path`, the nodes of each conversation in order.
    """

    nodes: DataFrame
    conversations: DataFrame


class Coder:
    """Ids of turns and back: a lossless tokenizer's ids, and one more id for each control string."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.first = self.tokenizer.get_vocab_size()
        self.control = {c: self.first + i for i, c in enumerate(CONTROLS)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def turn(self, role: str, role_ids: list[int], text_ids: list[int]) -> tuple[list[int], int]:
        """All ids of a turn, and where those of its text begin."""
        own = MARKS.get(role)
        head = [self.control[own[0]]] if own else [
            self.control[ROLE_MARKS[0]], *role_ids, self.control[ROLE_MARKS[1]]]
        return [*head, *text_ids, self.control[own[1] if own else OTHER_END]], len(head)


def _encoded(turns: DataFrame, tokenizer: str) -> DataFrame:
    """`row, conv_id, turn, role, digest, length, learn_begin, learn_end, ids` of every turn."""

    def encode(batches):
        coder = Coder(tokenizer)
        for batch in batches:
            role, text = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            # the role's own length keeps role and text apart
            digests = [hashlib.sha256(b"%d:" % len(r.encode()) + r.encode() + t.encode()).digest() for r, t in zip(role, text, strict=True)]
            others = sorted({r for r in role if r not in MARKS})
            names = dict(zip(others, coder.encode(others), strict=True))
            whole = [coder.turn(r, names.get(r, []), ids) for r, ids in zip(role, coder.encode(text), strict=True)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(4)), pa.array(digests, pa.binary()),
                pa.array([len(ids) for ids, _ in whole], pa.int32()),
                pa.array([at if r == LEARNED else 0 for r, (_, at) in zip(role, whole, strict=True)], pa.int32()),
                pa.array([len(ids) - 1 if r == LEARNED else 0 for r, (ids, _) in zip(role, whole, strict=True)], pa.int32()),
                pa.array([np.array(ids, "<u4").tobytes() for ids, _ in whole], pa.binary())],
                ["row", "conv_id", "turn", "role", "digest", "length", "learn_begin", "learn_end", "ids"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    order = turns.schema["turn"].dataType.simpleString()
    return turns.mapInArrow(encode, f"row long, conv_id {kind}, turn {order}, role string, digest binary, length int, "
                                    "learn_begin int, learn_end int, ids binary")


def _chained(batches):
    """Names of the nodes of each conversation: digests of the turn and of the node before it."""
    for batch in batches:
        turns = batch.column(1)
        digests, offsets = turns.flatten().field("digest").to_pylist(), turns.offsets.to_pylist()
        path = []
        for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
            name = b""
            for digest in digests[begin - offsets[0]:end - offsets[0]]:
                name = hashlib.sha256(name + digest).digest()[:16]
                path.append(name)
        flat = turns.flatten()
        bounds = pa.array(np.array(offsets) - offsets[0], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pa.array(path, pa.binary())),
                                          *(pa.ListArray.from_arrays(bounds, flat.field(c)) for c in ("row", "length"))],
                                         ["conv_id", "path", "rows", "lengths"])


def _shared(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Walk:
    """The nodes on the way to the conversation at hand: names, and where their tokens begin and end."""

    def __init__(self, total: int = 0, path: list | None = None, begins: list | None = None, ends: list | None = None) -> None:
        self.total, self.path, self.begins, self.ends = total, path or [], begins or [], ends or []

    def to(self, path: list[bytes], lengths: list[int]) -> int:
        """Go to the next conversation in order; how many of its nodes are known."""
        known = _shared(self.path, path)
        del self.begins[known:], self.ends[known:]
        self.path = path
        for n in lengths[known:]:
            self.begins.append(self.total)
            self.total += n
            self.ends.append(self.total)
        return known


def _bounds(paths: DataFrame) -> dict[int, tuple]:
    """For each partition of the sorted paths: tokens before it, and the way to the path before its first.

    Of each partition the driver gets two paths with their lengths and one number, and joins them in order.
    """
    from pyspark import TaskContext

    def ends(batches):
        first, walk, lengths = None, _Walk(), None
        for batch in batches:
            for path, lengths in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                first = first or (path, lengths)
                walk.to(path, lengths)
        if first:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()]), "total": pa.array([walk.total]),
                "first": pa.array([first[0]], pa.list_(pa.binary())), "sizes": pa.array([first[1]], pa.list_(pa.int32())),
                "last": pa.array([walk.path], pa.list_(pa.binary())), "begins": pa.array([walk.begins], pa.list_(pa.int64())),
                "ends": pa.array([walk.ends], pa.list_(pa.int64()))})

    out, total = {}, 0
    path, begins, ended = [], [], []
    for r in sorted(paths.mapInArrow(ends, "part long, total long, first array<binary>, sizes array<int>, last array<binary>, "
                                           "begins array<long>, ends array<long>").collect(), key=lambda r: r.part):
        out[r.part] = total, path, begins, ended
        known = _shared(path, [bytes(x) for x in r.first])
        again = sum(r.sizes[:known])  # tokens that the partition counted although they are known
        moved = [(begins[i], ended[i]) if e <= again else (b - again + total, e - again + total)
                 for i, (b, e) in enumerate(zip(r.begins, r.ends, strict=True))]
        path, begins, ended = [bytes(x) for x in r.last], [m[0] for m in moved], [m[1] for m in moved]
        total += r.total - again
    return out


def _merged(begins: list[int], ends: list[int], base: int) -> list[dict]:
    """Neighbouring places as one interval."""
    out: list[dict] = []
    for b, e in zip(begins, ends, strict=True):
        if out and out[-1]["end"] == b - base:
            out[-1]["end"] = e - base
        else:
            out.append({"begin": b - base, "end": e - base})
    return out


def format_trees(rows: DataFrame, tokenizer: str, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> Trees:
    """Prefix trees of all conversations, and the way of each conversation through them.

    `rows` has one row per turn. Turns are taken by `turn`, null first; turns with one number by role, then by a digest of role
    and text. A null role or text counts as empty. Rows with a null key are one conversation. Repeated rows are turns of their
    own. Two nodes are one if all turns up to them have equal roles and texts (by SHA-256). Texts keep every character;
    roles are compared as they are. Other columns are not read. `tokenizer` is the file of a tokenizer that loses nothing.
    `rows` is read once.

    Texts are tokenized where they are read and shuffled once, to the nodes they stand for. Of a conversation only digests and counts come
    together, some 60 bytes a turn, and equal conversations are one before they are sorted; a tree, however many
    conversations share it, is spread over the sorted partitions.
    """
    spark = rows.sparkSession
    plain = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a known role's mark is its name; others are written between marks
    safe = plain.withColumn("text", escaped(F.col("text"))).withColumn(
        "role", F.when(F.col("role").isin(*MARKS), F.col("role")).otherwise(escaped(F.col("role"))))
    turns = stored(_encoded(safe, tokenizer))
    one = F.struct("turn", "role", "digest", "row", "length")
    by_conversation = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    kind = rows.schema[key].dataType.simpleString()
    chained = stored(by_conversation.mapInArrow(_chained, f"conv_id {kind}, path array<binary>, rows array<long>, lengths array<int>"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = chained.groupBy(F.element_at("path", -1).alias("leaf")).agg(
        F.first(F.struct("path", "rows", "lengths")).alias("one")).select("one.*")
    paths = checkpointed(distinct.repartitionByRange(parts, F.slice("path", 1, KEY_TURNS)).sortWithinPartitions("path"))
    bounds = spark.sparkContext.broadcast(_bounds(paths))

    def laid_out(batches):
        from pyspark import TaskContext

        total, path, begins, ends = bounds.value.get(TaskContext.get().partitionId(), (0, [], [], []))
        walk = _Walk(total, path, list(begins), list(ends))
        for batch in batches:
            out = []
            for path, own, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                known = walk.to(path, lengths)
                at = sum(lengths[:known])
                for d in range(known, len(path)):
                    tree = walk.begins[0]
                    out.append((path[d], path[d - 1] if d else None, tree, d, walk.begins[d] - tree, at,
                                _merged(walk.begins[:d], walk.ends[:d], tree), own[d]))
                    at += lengths[d]
            columns = zip(*out, strict=True) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (
                pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.int64()), strict=True)],
                ["node", "parent", "tree", "depth", "begin", "position", "ancestors", "row"])

    nodes = paths.mapInArrow(laid_out, "node binary, parent binary, tree long, depth int, begin long, position long, "
                                       "ancestors array<struct<begin: long, end: long>>, row long")
    full = nodes.join(turns.select("row", "length", "learn_begin", "learn_end", "ids"), "row").select(
        "node", "parent", "tree", "depth", "begin", "length", "position", "ancestors", "learn_begin", "learn_end", "ids")
    return Trees(stored(full), chained.select("conv_id", "path"))


def read_back(trees: Trees, tokenizer: str) -> DataFrame:
    """`conv_id, place, role, text, learned, n_formatted` of every turn, decoded from the tokens of the trees.

    `place` counts the turns of a conversation from 0; `learned` is the text under the loss mask, null if there is none;
    `n_formatted` counts the characters of the turn with its marks and escapes.
    """

    def decoded(batches):
        coder = Coder(tokenizer)
        name = {i: c for c, i in coder.control.items()}
        role_of = {coder.control[a]: r for r, (a, _) in MARKS.items()}
        for batch in batches:
            roles, texts, masks, sizes = [], [], [], []
            for raw, a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                ids = np.frombuffer(raw, "<u4")
                marks = np.flatnonzero(ids >= coder.first)
                middle = int(marks[-2])  # the last mark before the text
                roles.append(ids[1:middle].tolist() if len(marks) > 2 else [])
                texts.append(ids[middle + 1:-1].tolist())
                masks.append(ids[a:b].tolist())
                sizes.append((ids[0], sum(len(name[int(i)]) for i in ids[marks])))
            role_texts, text_texts, mask_texts = coder.decode(roles), coder.decode(texts), coder.decode(masks)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([role_of.get(int(mark)) or unescaped(r) for (mark, _), r in zip(sizes, role_texts, strict=True)], pa.string()),
                pa.array([unescaped(t) for t in text_texts], pa.string()),
                pa.array([unescaped(t) if b else None for t, b in zip(mask_texts, batch.column(3).to_pylist(), strict=True)], pa.string()),
                pa.array([n + len(r) + len(t) for (_, n), r, t in zip(sizes, role_texts, text_texts, strict=True)], pa.int64())],
                ["node", "role", "text", "learned", "n_formatted"])

    texts = trees.nodes.select("node", "ids", "learn_begin", "learn_end").mapInArrow(
        decoded, "node binary, role string, text string, learned string, n_formatted long")
    ways = trees.conversations.select("conv_id", F.posexplode("path").alias("place", "node"))
    return lookup(ways, texts, "node", "inner").select("conv_id", "place", "role", "text", "learned", "n_formatted")
