"""Prefix trie of conversations by union-find over the LCP edges of sorted neighbours.

1. ``rebuilt_turns`` numbers the turns of each conversation and puts the head
   of its base conversation in front. A turn is (role, text); its digest
   stands for it from there on.
2. Segments: a conversation is cut every ``SPAN`` turns. The digest of all
   segments before one is its stem, so a segment with its stem stands for the
   whole prefix and no task holds more than ``SPAN`` turns of a conversation.
   A conversation of a multiple of ``SPAN`` turns ends in an empty segment.
   Conversations with equal sequences collapse to one before anything is sorted.
3. The distinct segments are range-partitioned and sorted by (stem, turns);
   neighbours share as many turns as their longest common prefix (LCP).
4. In each partition union-find takes the edges in descending depth: the
   components joined at one depth become the children of the branching node
   of that depth. What may still meet a neighbouring partition, at most the
   two outer edges of the forest, is contracted to a few elements per depth
   and merged with those of the next ``FAN`` partitions, and so on until
   nothing is open. An element keeps its members' number, smallest id, leaves and
   saved tokens, all of which add up, so contracted parts are never opened again.
5. A finished component is a run of nodes from its own depth up to its
   parent's, owned by its smallest member. Runs become rows with the owner's
   turns; a run across a segment's end continues in the stem below.

Saved tokens add up as follows: where m components meet at depth d, all but
one save the tokens of the first d turns once; a node at depth d takes off
what its members share above it.

Null roles and texts are empty. Rows without a conversation id belong to no
conversation and are left out. Turns are ordered by number, nulls first, equal
numbers by their digest; repeated rows are turns of their own. Only an empty
table (or one without any id) has no root. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hopgrid.llm.common import numbered, sorted_groups, stored

SPAN = 64            # turns of a segment
FAN = 64             # neighbouring partitions whose contracted forests one task merges
STRETCH = 1024       # segments of a conversation that one window task adds up
CHUNK = 4096         # conversation ids per piece of text on the way to a hash
HEAD = 6             # a head has fewer turns than this


# --- rebuilding ---

def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("long")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, digest, tokens) of every rebuilt turn, and every conversation id (conv)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.concat(F.char_length(role), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(turn, 256)), 1, 16).alias("digest"), F.char_length(text).cast("long").alias("tokens"))
    placed = stored(numbered(stored(rows, "trie-turns"), ["conv"], ["turn", "digest"], "trie-order")
                    .select("conv", "place", "size", "digest", "tokens"), "trie-placed")
    convs = placed.where("place = 0").select("conv", "size")
    bases = convs.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    shifts = (convs.withColumn("base", F.col("conv") - F.col("conv") % 100).join(bases, "base", "left")
              .withColumn("h", head_length(F.col("conv")))
              .withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0)))))
    heads = placed.where(f"place < {HEAD}").select(F.col("conv").alias("base"), F.col("place").alias("pos"), "digest", "tokens")
    front = shifts.where("taken > 0").join(heads, "base").where("pos < taken").select("conv", "pos", "digest", "tokens")
    # One row per stretch of turns, so that a conversation with very many of them is joined by many tasks.
    stretches = shifts.select(F.col("conv").alias("of"), "h", "taken",
                              F.explode(F.sequence(F.lit(0), F.expr(f"(size - 1) div {STRETCH}"))).alias("stretch"))
    own = (placed.join(stretches, (F.col("conv") == F.col("of")) & (F.expr(f"place div {STRETCH}") == F.col("stretch")))
           .where("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("pos"), "digest", "tokens"))
    return front.unionByName(own), convs.select("conv")


# --- segments ---

def _running(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Adds for each name -> expression its aggregate over the earlier segments of the conversation, and over all (``all_``).

    Windows run inside stretches of segments and over the totals of stretches.
    """
    stretch = F.expr(f"s div {STRETCH}")
    totals = rows.groupBy(F.col("conv").alias("_conv"), stretch.alias("_stretch")).agg(*[F.expr(e).alias(f"_{n}") for n, e in sums.items()])
    over = Window.partitionBy("_conv")
    earlier = over.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)

    def again(expression: str, column: str) -> Column:
        return F.expr(f"{expression.split('(')[0]}({column})")

    totals = totals.select("_conv", "_stretch", *[
        c for n, e in sums.items() for c in (F.coalesce(again(e, f"_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}"),
                                             again(e, f"_{n}").over(over).alias(f"all_{n}"))])
    inside = Window.partitionBy("conv", stretch).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_in_{n}": F.coalesce(F.expr(e).over(inside), F.lit(0)) for n, e in sums.items()})
    joined = rows.join(totals, (F.col("conv") == F.col("_conv")) & (stretch == F.col("_stretch")))

    def both(name: str) -> Column:
        a, b = F.col(f"_before_{name}"), F.col(f"_in_{name}")
        return (a.bitwiseXOR(b) if sums[name].startswith("bit_xor") else a + b).alias(name)

    return joined.select(*[c for c in rows.columns if not c.startswith("_in_")], *[both(n) for n in sums], *[f"all_{n}" for n in sums])


def _segments(turns: DataFrame, convs: DataFrame, span: int) -> DataFrame:
    """conv, s, key (digests), tokens (per turn), edge (tokens of the turn before), stem, before (tokens before), totals."""
    place = F.col("pos") % span
    entry = F.struct("pos", "digest", "tokens").alias("entry")
    s = F.expr(f"pos div {span}")
    rows = turns.select("conv", s.alias("s"), entry, F.lit(0).cast("long").alias("edge")).unionByName(
        # The last turn of a segment announces the next one, which may be empty.
        turns.where(place == span - 1).select("conv", (s + 1).alias("s"), F.lit(None).alias("entry"), F.col("tokens").alias("edge"))
    ).unionByName(convs.select("conv", F.lit(0).cast("long").alias("s"), F.lit(None).alias("entry"), F.lit(0).cast("long").alias("edge")))
    grouped = rows.groupBy("conv", "s").agg(F.sort_array(F.collect_list("entry")).alias("entries"), F.max("edge").alias("edge"))
    segments = grouped.select("conv", "s", F.col("entries.digest").alias("key"), F.col("entries.tokens").alias("tokens"), "edge")
    return _running(segments, {
        "stem_a": "bit_xor(xxhash64(s, key))", "stem_b": "bit_xor(xxhash64('b', key, s))",
        "before": "sum(aggregate(tokens, 0L, (a, x) -> a + x))", "turns": "sum(size(key))"})


# --- the forest ---

@dataclass(slots=True)
class Part:
    """What a component, or some of its members, adds up to."""
    owner: int
    n: int
    leaves: int
    saved: int
    children: int
    end: int | None = None   # the conversation whose sequence ends at this very depth


@dataclass(slots=True)
class Node:
    depth: int
    own: Part | None = None
    kids: list[Node] = field(default_factory=list)
    shared: int = 0          # tokens of the first ``depth`` turns
    name: bytes | None = None
    parent: Node | None = None
    first: int = 0           # elements of the task it spans
    last: int = 0
    more: bool = False       # goes on in the next segment
    total: Part | None = None


def combined(parts: list[Part], shared: int) -> Part:
    """Parts of one node: its branches and what stands at its own depth."""
    return Part(min(p.owner for p in parts), sum(p.n for p in parts), sum(p.leaves for p in parts),
                sum(p.saved for p in parts) + (len(parts) - 1) * shared, sum(p.children for p in parts),
                next((p.end for p in parts if p.end is not None), None))


def as_branch(total: Part) -> Part:
    return Part(total.owner, total.n, total.leaves, total.saved, 1)


def grow(nodes: list[Node], lcp: list[int], shared: list[int], names: list[bytes]) -> list[Node]:
    """Union-find over the edges (i - 1, i) of depth ``lcp[i]`` in descending depth; returns the roots, left to right."""
    up = list(range(len(nodes)))
    at = dict(enumerate(nodes))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in sorted((i for i in range(1, len(nodes)) if lcp[i] >= 0), key=lambda i: -lcp[i]):
        left, right = find(i - 1), find(i)
        a, b, depth = at[left], at[right], lcp[i]
        first, last = a.first, b.last
        if a.depth > depth and b.depth > depth:
            node = Node(depth, kids=[a, b])
        elif a.depth == depth and b.depth == depth:
            node, other = (a, b) if len(a.kids) >= len(b.kids) else (b, a)
            node.kids.extend(other.kids)
            parts = [p for p in (node.own, other.own) if p]
            node.own = combined(parts, shared[i]) if parts else None
        else:
            node, kid = (a, b) if a.depth == depth else (b, a)
            node.kids.append(kid)
        node.first, node.last, node.shared, node.name = first, last, shared[i], names[i]
        up[right] = left
        at[left] = node
    return [at[i] for i in range(len(nodes)) if up[i] == i]


def add_up(roots: list[Node]) -> list[Node]:
    """Totals of all nodes and their parents; children before parents."""
    order, ahead = [], list(roots)
    while ahead:
        node = ahead.pop()
        order.append(node)
        for kid in node.kids:
            kid.parent = node
        ahead.extend(node.kids)
    order.reverse()
    for node in order:
        parts = [*([node.own] if node.own else []), *[as_branch(k.total) for k in node.kids]]
        node.total = combined(parts, node.shared)
    return order


Element = tuple[Node, int, int, bytes]   # with depth, tokens and name of the edge before it


def contract(nodes: list[Node], lcp: list[int], shared: list[int], names: list[bytes], right: int) -> tuple[list[Node], list[Element]]:
    """Finished nodes (with totals and parents) and the elements left of a run of sorted neighbours.

    ``lcp[0]`` and ``right`` are the edges to the neighbouring runs. A node is
    finished if neither of them reaches below its parent.
    """
    for i, node in enumerate(nodes):
        node.first = node.last = i
    roots = grow(nodes, lcp, shared, names)
    order, end = add_up(roots), len(nodes) - 1

    def finished(node: Node) -> bool:
        above = node.parent.depth if node.parent else -1
        return (node.first > 0 or lcp[0] <= above) and (node.last < end or right <= above)

    unfinished = {id(node) for node in order if not finished(node)}
    done = [node for node in order if id(node) not in unfinished]
    left: list[Element] = []

    def emit(root: Node) -> None:
        """In order: the outer left branch, what is finished in between, the outer right branch.

        The first element takes the edge to the left neighbour; the others the depth of the node that joins them.
        """
        work, edge = [(root, None)], (lcp[0], shared[0], names[0]) if not left else (-1, 0, b"")
        while work:
            node, part = work.pop()
            if part is not None or not any(id(k) in unfinished for k in node.kids):
                left.append((Node(node.depth, own=part or node.total, name=node.name, more=node.more), *edge))
                edge = following(work)
                continue
            open_kids = sorted((k for k in node.kids if id(k) in unfinished), key=lambda k: k.first)
            rest = [*([node.own] if node.own else []), *[as_branch(k.total) for k in node.kids if id(k) not in unfinished]]
            middle = [(node, combined(rest, node.shared))] if rest else []
            before = [(k, None) for k in open_kids if k.first == 0]
            after = [(k, None) for k in open_kids if k.first != 0]
            work.extend(reversed(before + middle + after))

    def following(work: list) -> tuple[int, int, bytes]:
        """The edge to the next element: the node above both."""
        if not work:
            return -1, 0, b""
        node, part = work[-1]
        joint = node if part is not None else node.parent
        return joint.depth, joint.shared, joint.name

    for root in sorted((r for r in roots if id(r) in unfinished), key=lambda r: r.first):
        emit(root)
    return done, left


RECORD = pa.schema([
    ("open", pa.bool_()), ("task", pa.int64()), ("at", pa.int64()), ("s", pa.int64()), ("depth", pa.int64()), ("low", pa.int64()),
    ("more", pa.bool_()), ("owner", pa.int64()), ("n", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
    ("children", pa.int64()), ("ended", pa.int64()), ("lcp", pa.int64()), ("shared", pa.int64()), ("edge_name", pa.binary()),
    ("right", pa.int64()), ("name", pa.binary()), ("parent_owner", pa.int64()), ("parent_name", pa.binary())])
RECORD_SQL = ", ".join(f"{f.name} {'boolean' if f.type == pa.bool_() else 'binary' if f.type == pa.binary() else 'long'}" for f in RECORD)


def _written(task: int, segment: list[int], nodes: list[Node], lcp: list[int], shared: list[int], names: list[bytes],
             right: int, span: int) -> pa.RecordBatch:
    """Contract one run and write finished nodes and open elements as records."""
    done, left = contract(nodes, lcp, shared, names, right)
    unfinished = {id(n.parent) for n in done if n.parent} - {id(n) for n in done}
    rows = []
    for n in done:
        p, s = n.total, segment[n.first]
        over = n.parent
        rows.append((False, task, n.first, s, n.depth, over.depth + 1 if over else s * span, n.more, p.owner, p.n, p.leaves, p.saved,
                     p.children, p.end, None, None, None, None, n.name,
                     over.total.owner if over and id(over) not in unfinished else None,
                     over.name if over and id(over) in unfinished else None))
    s = segment[0]
    for i, (n, depth, tokens, name) in enumerate(left):
        p = n.own
        if i and depth < 0:
            s = segment[-1]  # what is open belongs to the stem at the left end or to that at the right end
        rows.append((True, task, i, s, n.depth, None, n.more, p.owner, p.n, p.leaves, p.saved, p.children, p.end,
                     depth, tokens, name, right, n.name, None, None))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)


def _edge(before: dict | None, row: dict, span: int) -> tuple[int, int, bytes]:
    """Depth of the common prefix with the segment before (-1: another stem), its tokens and its name."""
    stem = ("s", "stem_a", "stem_b")
    if before is None or any(before[c] != row[c] for c in stem):
        return -1, 0, b""
    k, same = row["key"], 0
    for a, b in zip(before["key"], k):
        if a != b:
            break
        same += 1
    name = blake2b(b"%d:%d:%d:%d:" % (*[row[c] for c in stem], same) + b"".join(k[:same]), digest_size=16)
    return row["s"] * span + same, row["before"] + sum(row["tokens"][:same]), name.digest()


def _first_round(classes: DataFrame, span: int) -> DataFrame:
    """Sort the distinct segments and contract each partition's run."""
    keys = ["s", "stem_a", "stem_b", "key"]
    dealt = stored(classes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("at", F.monotonically_increasing_id()), "trie-sorted")
    task = F.shiftright("at", 33)
    row = F.struct(*keys, "before", "tokens")
    ends = dealt.groupBy(task.alias("task")).agg(F.min_by(row, "at").alias("head"), F.max_by(row, "at").alias("tail"))
    # One row per task of the sort: its neighbours' edges.
    line = Window.orderBy("task")
    ends = ends.select("task", "head", F.lag("tail").over(line).alias("prior"), "tail", F.lead("head").over(line).alias("next"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["task"], *_edge(r["prior"], r["head"], span), _edge(r["tail"], r["next"], span)[0] if r["next"] else -1)
                    for r in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    names = ["task", "lcp", "shared", "edge_name", "right"]
    edges = ends.mapInArrow(bounds, "task long, lcp long, shared long, edge_name binary, right long")
    runs = dealt.withColumn("task", task).join(F.broadcast(edges), "task").repartition("task").sortWithinPartitions("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), table in sorted_groups(batches, ["task"]):
            rows = table.to_pylist()
            edges = [(r["lcp"], r["shared"], r["edge_name"]) if not i else _edge(rows[i - 1], r, span) for i, r in enumerate(rows)]
            right = rows[0]["right"]
            nodes = []
            for i, r in enumerate(rows):
                depth = r["s"] * span + len(r["key"])
                after = edges[i + 1][0] if i + 1 < len(rows) else right
                if len(r["key"]) == span:
                    own = Part(r["owner"], r["n"], r["deep_leaves"], r["deep_saved"], 1)
                else:
                    own = Part(r["owner"], r["n"], int(after != depth), r["saved"], 0, r["owner"])
                nodes.append(Node(depth, own, more=len(r["key"]) == span))
            yield _written(number, [r["s"] for r in rows], nodes, *map(list, zip(*edges)), right, span)

    return runs.mapInArrow(run, RECORD_SQL)


def _next_round(open_parts: DataFrame, span: int, fan: int) -> DataFrame:
    """Merge the contracted forests of ``fan`` neighbouring runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (task,), table in sorted_groups(batches, ["next_task"]):
            rows = table.to_pylist()
            nodes = [Node(r["depth"], Part(r["owner"], r["n"], r["leaves"], r["saved"], r["children"], r["ended"]),
                          name=r["name"], more=r["more"]) for r in rows]
            yield _written(task, [r["s"] for r in rows], nodes, [r["lcp"] for r in rows], [r["shared"] for r in rows],
                           [r["edge_name"] for r in rows], rows[-1]["right"], span)

    grouped = open_parts.withColumn("next_task", F.expr(f"task div {fan}"))
    return grouped.repartition("next_task").sortWithinPartitions("next_task", "task", "at").mapInArrow(run, RECORD_SQL)


def _forest(classes: DataFrame, span: int, fan: int) -> DataFrame:
    """All finished nodes of all stems: RECORD's columns, parents' owners filled in."""
    written, closed, late = stored(_first_round(classes, span), "trie-forest"), None, None
    while True:
        part = written.where("not open")
        closed = part if closed is None else closed.unionByName(part)
        open_parts = written.where("open")
        if open_parts.isEmpty():
            break
        written = stored(_next_round(open_parts, span, fan), "trie-forest")
        part = written.where("not open")
        late = part if late is None else late.unionByName(part)
    if late is None:
        return closed
    # Nodes finished after the first round lie on outer edges of runs: at most 2 * (span + 1) for each task of the sort.
    owners = late.where("name is not null").select(F.col("name").alias("_name"), F.col("owner").alias("_owner"))
    joined = closed.join(F.broadcast(owners), F.col("parent_name") == F.col("_name"), "left")
    return joined.withColumn("parent_owner", F.coalesce("parent_owner", "_owner")).drop("_name", "_owner")


# --- ends ---

def _end_hashes(ends: DataFrame) -> DataFrame:
    """end, ends_sha256 from (end, conv): ids ascending, comma-joined.

    A hash must read its input in order, so the last step of one node's list is
    one task; it gets texts of ``CHUNK`` ids each and holds one at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, sha256()
        for batch in batches:
            done = []
            for end, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if end != last:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = end, sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["end", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()])], ["end", "ends_sha256"])

    placed = numbered(ends, ["end"], ["conv"], "trie-ends")
    texts = placed.groupBy("end", F.expr(f"place div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("text"))
    dealt = texts.repartition("end").sortWithinPartitions("end", "chunk").select("end", "text")
    return dealt.mapInArrow(run, "end long, ends_sha256 string")


# --- the trie ---

def prefix_trie(conversations: DataFrame, span: int = SPAN, fan: int = FAN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt_turns(conversations)
    segments = stored(_segments(stored(turns, "trie-rebuilt"), convs, span), "trie-segments")
    whole = ["all_turns", "all_stem_a", "all_stem_b"]
    whole_of = segments.where("s = 0").select("conv", *whole, "all_before")
    sequences = stored(whole_of.groupBy(*whole).agg(
        F.min("conv").alias("end"), F.count("*").alias("copies"), F.first("all_before").alias("spent")), "trie-sequences")
    first = sequences.select(F.col("end").alias("conv"), "copies", "spent")
    # Only the first conversation of each distinct sequence goes on, a row per segment of it.
    kept = stored(segments.join(first, "conv"), "trie-kept")

    def classes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("s", "stem_a", "stem_b", "key").agg(
            F.min("conv").alias("owner"), F.sum("copies").alias("n"), F.first("before").alias("before"), F.first("tokens").alias("tokens"),
            F.sum((F.col("copies") - 1) * F.col("spent")).alias("saved"),
            F.sum("deep_leaves").alias("deep_leaves"), F.sum("deep_saved").alias("deep_saved"))

    below = kept.withColumns({"deep_leaves": F.lit(0).cast("long"), "deep_saved": F.lit(0).cast("long")})
    longer = below.where("s > 0")
    if not longer.isEmpty():
        # What each stem below the first segments adds by itself goes to its owner, and from there to every segment above.
        alone = _forest(classes(longer), span, fan).where("parent_owner is null")
        parts = alone.select(F.col("owner").alias("conv"), "s", F.col("leaves").alias("l"), F.col("saved").alias("t"))
        sums = _running(kept.join(parts, ["conv", "s"], "left").na.fill(0, ["l", "t"]), {"to_l": "sum(l)", "to_t": "sum(t)"})
        below = sums.withColumns({"deep_leaves": F.col("all_to_l") - F.col("to_l") - F.col("l"),
                                  "deep_saved": F.col("all_to_t") - F.col("to_t") - F.col("t")})
    forest = stored(_forest(classes(below), span, fan), "trie-nodes")

    # The parent of a stem's top lies in the stem above: its owner, or who took over at that very depth.
    top = (F.col("s") > 0) & F.col("parent_owner").isNull()
    over = forest.where("more").select((F.col("s") + 1).alias("_s"), F.col("owner").alias("_owner"),
                                       F.when(F.col("low") >= F.col("depth"), F.col("parent_owner")).alias("_over"))
    tops = forest.where(top).join(over, (F.col("s") == F.col("_s")) & (F.col("owner") == F.col("_owner")), "left")
    runs = forest.where(~top).withColumn("above", F.col("parent_owner")).unionByName(
        tops.withColumn("above", F.coalesce("_over", "owner")).drop("_s", "_owner", "_over"))

    ends = whole_of.join(sequences.select("end", *whole), whole).select("end", "conv")
    hashes = _end_hashes(stored(ends, "trie-members"))
    nothing = F.sha2(F.lit(""), 256)
    runs = runs.where("ended is null").withColumn("ends_sha256", F.lit(None).cast("string")).unionByName(
        runs.where("ended is not null").join(hashes.withColumnRenamed("end", "ended"), "ended"))

    runs = runs.withColumn("high", F.when(F.col("more"), F.col("depth") - 1).otherwise(F.col("depth"))).where("low <= high")
    owner_turns = kept.select(F.col("conv").alias("_conv"), F.col("s").alias("_s"), "before", "edge", "tokens")
    nodes = (runs.drop("shared").join(owner_turns, (F.col("owner") == F.col("_conv")) & (F.col("s") == F.col("_s")))
             .withColumn("d", F.explode(F.sequence("low", "high"))))
    inside = F.col("d") - F.col("s") * span
    earlier = F.aggregate(F.slice("tokens", F.lit(1), F.greatest(inside - 1, F.lit(0)).cast("int")), F.lit(0).cast("long"), lambda a, x: a + x)
    above_tokens = F.when(inside == 0, F.col("before") - F.col("edge")).otherwise(F.col("before") + earlier)
    last = F.col("d") == F.col("high")
    return nodes.select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == 0, F.lit(None)).when(F.col("d") == F.col("low"), F.col("above")).otherwise(F.col("owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last & ~F.col("more"), F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - (F.col("n") - 1) * above_tokens).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"))
