"""Schemas that drift: minimum-cost edit scripts between schema trees, compiled into projections.

A schema is a tree of named, typed nodes (dots in a name separate levels).  The
distance between two nodes is the cost of turning one into the other and its
children into the other's; children have no order, so they are matched by a
minimum-cost assignment of whole subtrees, bottom up (the top-down edit distance
of unordered trees).  A name that stays under its parent is that node.  What the
script deletes in one place and adds in another becomes a move where that is
cheaper, again by assignment.

Over many loads only fields that changed travel: deliveries are compared field
by field in one aggregate, and only those that both gained and lost fields reach
the tree comparison.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from difflib import SequenceMatcher
from math import sqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..session import ship

INDEL = 0.25  #: cost of adding or deleting a node; a rename must cost less than both together
MOVE = 0.2
RETYPE = 0.3

# Usual short writings of words in field names that are not their letters in order.
SHORT_WORDS = {
    "no": "number", "nr": "number", "num": "number", "nbr": "number", "dt": "date", "ts": "timestamp", "cd": "code",
    "qty": "quantity", "id": "identifier", "tel": "telephone", "mfr": "manufacturer", "lang": "language", "desc": "description",
}


class Field(NamedTuple):
    name: str
    kind: str | None = None
    share: float | None = None  #: of filled rows
    rows: int | None = None


class Edit(NamedTuple):
    kind: str  # added, removed, renamed, moved, retyped
    new: str | None
    old: str | None


def words(name: str) -> list[str]:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return [w for w in re.split(r"[^0-9a-z]+", spaced.lower()) if w]


def _shortens(short: str, long: str) -> bool:
    """The same word, a known short writing, or its first letter and others in order."""
    if short == long or SHORT_WORDS.get(short) == long:
        return True
    if len(short) < 2 or len(short) >= len(long) or short[0] != long[0]:
        return False
    rest = iter(long[1:])
    return all(ch in rest for ch in short[1:])


def name_similarity(a: str, b: str) -> float:
    """0 to 1: how likely two field names are writings of one name."""
    x, y = words(a), words(b)
    if not x or not y:
        return 0.0
    if "".join(x) == "".join(y) or sorted(x) == sorted(y):
        return 1.0
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if len(large) - len(small) <= 1 and all(w in large for w in small):
        return 0.9
    if len(x) == len(y):
        left = list(y)
        for w in x:
            hit = next((v for v in left if _shortens(w, v) or _shortens(v, w)), None)
            if hit is None:
                break
            left.remove(hit)
        else:
            return 0.9
    return 0.8 * SequenceMatcher(None, "".join(x), "".join(y)).ratio()


def rename_cost(old: Field, new: Field) -> float:
    """Names apart, types apart, and shares apart by more than one standard error of the two samples."""
    cost = 1.0 - name_similarity(old.name.rsplit(".", 1)[-1], new.name.rsplit(".", 1)[-1])
    if old.kind and new.kind and old.kind != new.kind:
        cost += RETYPE
    if old.share is not None and new.share is not None and old.rows and new.rows:
        p = (old.share * old.rows + new.share * new.rows + 1) / (old.rows + new.rows + 2)
        chance = sqrt(max(p * (1 - p), 0.0) * (1 / old.rows + 1 / new.rows))
        cost += min(0.3, max(0.0, abs(old.share - new.share) - chance))
    return cost


def assign(cost: Sequence[Sequence[float]], skip_row: Sequence[float], skip_col: Sequence[float]) -> list[tuple[int, int]]:
    """Minimum-cost matching of rows to columns where each may stay out at its own price.

    A pair that costs no less than both its skips is never taken, so what remains falls into parts that
    are solved alone (the Hungarian method, a row at a time); ties go to the first row and column.
    """
    n, m = len(skip_row), len(skip_col)
    gain = np.array(cost, dtype=float).reshape(n, m) - np.array(skip_row, dtype=float)[:, None] - np.array(skip_col, dtype=float)[None, :]
    links = np.argwhere(gain < -1e-12)
    part = list(range(n + m))

    def root(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    for i, j in links:
        part[root(int(i))] = root(n + int(j))
    parts: dict[int, tuple[list[int], list[int]]] = {}
    for i in sorted({int(i) for i, _ in links}):
        parts.setdefault(root(i), ([], []))[0].append(i)
    for j in sorted({int(j) for _, j in links}):
        parts[root(n + j)][1].append(j)
    out: list[tuple[int, int]] = []
    for rows, cols in parts.values():
        out += [(rows[i], cols[j]) for i, j in _hungarian(gain[np.ix_(rows, cols)])]
    return sorted(out)


def _hungarian(gain: np.ndarray) -> list[tuple[int, int]]:
    """Matching of lowest sum; a row that stays out adds nothing (it has a column of its own at 0)."""
    n, m = gain.shape
    big = np.hstack([np.minimum(gain, 1e6), np.full((n, n), 1e6)])
    big[np.arange(n), m + np.arange(n)] = 0.0
    u, v, owner = np.zeros(n), np.zeros(m + n + 1), np.full(m + n + 1, -1)
    for i in range(n):
        free = m + n  # the column that stands for the row being placed
        owner[free], at = i, free
        low, used, back = np.full(m + n, np.inf), np.zeros(m + n + 1, dtype=bool), np.full(m + n, -1)
        while owner[at] >= 0:
            used[at] = True
            row = owner[at]
            now = big[row] - u[row] - v[:-1]
            better = ~used[:-1] & (now < low - 1e-12)
            low[better], back[better] = now[better], at
            open_ = np.where(used[:-1], np.inf, low)
            nxt = int(np.argmin(open_))
            delta = open_[nxt]
            u[owner[used]] += delta
            v[used] -= delta
            low[~used[:-1]] -= delta
            at = nxt
        while at != free:
            owner[at] = owner[back[at]]
            at = back[at]
    return [(int(owner[j]), j) for j in range(m) if owner[j] >= 0]


class _Tree:
    def __init__(self, fields: Iterable[Field]):
        self.nodes: dict[str, Field] = {}
        for f in sorted(fields, key=lambda f: f.name):
            parts = f.name.split(".")
            for k in range(1, len(parts)):
                self.nodes.setdefault(".".join(parts[:k]), Field(".".join(parts[:k])))
            self.nodes[f.name] = f
        self.children: dict[str, list[str]] = {"": []}
        for name in sorted(self.nodes):
            self.children.setdefault(name, [])
            self.children.setdefault(name.rpartition(".")[0], []).append(name)
        self.size: dict[str, int] = {}
        for name in sorted(self.nodes, key=lambda n: -n.count(".")):
            self.size[name] = 1 + sum(self.size[c] for c in self.children[name])

    def leaves(self, name: str) -> list[str]:
        below = self.children[name]
        return [x for c in below for x in self.leaves(c)] if below else [name]


def _leaf(name: str) -> str:
    return name.rsplit(".", 1)[-1]


class _Comparison:
    """Distances of subtrees, each computed once."""

    def __init__(self, a: _Tree, b: _Tree):
        self.a, self.b = a, b
        self.known: dict[tuple[str, str], tuple[float, list[tuple[str, str]]]] = {}

    def node(self, x: str, y: str) -> float:
        old, new = self.a.nodes[x], self.b.nodes[y]
        own = RETYPE * bool(old.kind and new.kind and old.kind != new.kind) if _leaf(x) == _leaf(y) else rename_cost(old, new)
        return own + self.forest(x, y)[0]

    def forest(self, x: str, y: str) -> tuple[float, list[tuple[str, str]]]:
        """Cost of turning the children of ``x`` into those of ``y``, and which become which."""
        if (x, y) in self.known:
            return self.known[x, y]
        was, now = ({_leaf(n): n for n in t.children[at]} for t, at in ((self.a, x), (self.b, y)))
        pairs = [(was[n], now[n]) for n in sorted(was.keys() & now.keys())]
        lost, gained = [was[n] for n in sorted(was.keys() - now.keys())], [now[n] for n in sorted(now.keys() - was.keys())]
        out, put = [INDEL * self.a.size[n] for n in lost], [INDEL * self.b.size[n] for n in gained]
        cost = sum(self.node(i, j) for i, j in pairs) + sum(out) + sum(put)
        if lost and gained:
            prices = [[self.node(i, j) for j in gained] for i in lost]
            for i, j in assign(prices, out, put):
                pairs.append((lost[i], gained[j]))
                cost += prices[i][j] - out[i] - put[j]
        self.known[x, y] = cost, pairs
        return cost, pairs


def script_cost(old: Iterable[Field], new: Iterable[Field]) -> float:
    """Cost of the cheapest script without moves."""
    return _Comparison(_Tree(old), _Tree(new)).forest("", "")[0]


def edit_script(old: Iterable[Field], new: Iterable[Field]) -> list[Edit]:
    """Minimum-cost script from one schema to the other, sorted by kind and name.

    Nodes without a written parent get one.  A renamed or moved parent takes its children along: they are
    no edits.  Of a subtree that is added or removed the fields (leaves) are named.
    """
    a, b = _Tree(old), _Tree(new)
    compare = _Comparison(a, b)
    edits: list[Edit] = []
    lost: list[str] = []
    gained: list[str] = []

    def walk(x: str, y: str) -> None:
        pairs = compare.forest(x, y)[1]
        for i, j in pairs:
            if _leaf(i) != _leaf(j):
                edits.append(Edit("renamed", j, i))
            elif a.nodes[i].kind and b.nodes[j].kind and a.nodes[i].kind != b.nodes[j].kind:
                edits.append(Edit("retyped", j, None))
            walk(i, j)
        lost.extend(n for n in a.children[x] if n not in {i for i, _ in pairs})
        gained.extend(n for n in b.children[y] if n not in {j for _, j in pairs})

    walk("", "")
    # moves: whole subtrees first, then what they leave of their parts
    while lost and gained:
        below = [[n for top in tops for n in t.nodes if n == top or n.startswith(f"{top}.")] for t, tops in ((a, lost), (b, gained))]
        same = [(MOVE + compare.node(i, j) - INDEL * (a.size[i] + b.size[j]), i, j) for i in below[0] for j in below[1] if _leaf(i) == _leaf(j)]
        moves = _cheapest_moves([m for m in same if m[0] < -1e-12])
        if not moves:
            break
        for i, j in moves:
            edits.append(Edit("moved", j, i))
            walk(i, j)
        for t, tops, gone in ((a, lost, {i for i, _ in moves}), (b, gained, {j for _, j in moves})):
            tops[:] = [n for top in tops for n in _without(t, top, gone)]
    edits += [Edit("removed", None, n) for top in lost for n in a.leaves(top) if not a.children[n]]
    edits += [Edit("added", n, None) for top in gained for n in b.leaves(top) if not b.children[n]]
    return sorted(edits, key=lambda e: (e.kind, e.new or "", e.old or ""))


def _cheapest_moves(found: list[tuple[float, str, str]]) -> list[tuple[str, str]]:
    """An assignment among the topmost subtrees that may move: one inside another waits for the next turn."""
    olds, news = ({m[k] for m in found} for k in (1, 2))
    top = lambda n, all_: not any(n.startswith(f"{x}.") for x in all_)
    rows, cols = sorted(n for n in olds if top(n, olds)), sorted(n for n in news if top(n, news))
    price = {(i, j): c for c, i, j in found}
    if not any((i, j) in price for i in rows for j in cols):  # crossing levels: the cheapest one alone
        return [min(found)[1:]] if found else []
    pairs = assign([[price.get((i, j), 1e6) for j in cols] for i in rows], [0.0] * len(rows), [0.0] * len(cols))
    return [(rows[i], cols[j]) for i, j in pairs]


def _without(t: _Tree, top: str, gone: set[str]) -> list[str]:
    """``top`` unless parts of it have moved away: then the parts that stayed (an emptied parent is none)."""
    if top in gone:
        return []
    if not any(g.startswith(f"{top}.") for g in gone):
        return [top]
    return [n for c in t.children[top] for n in _without(t, c, gone)]


# --------------------------------------------------------------------------- over many loads

_CHANGE = "array<struct<field_name:string,prev_field_name:string,change_kind:string>>"


def fields_of_loads(df: DataFrame) -> DataFrame:
    """``feed, table_name, load_no, name, kind, share, rows``: one row per field of a delivered table.

    Names are trimmed in lower case, missing ones left out; a field named more than once counts once
    (of different types the lowest, of shares the one of most rows).
    """
    named = df.select(
        clean("feed").alias("feed"), F.lower(clean("table_name")).alias("table_name"), F.col("load_no").cast("bigint").alias("load_no"),
        F.lower(clean("field_name")).alias("name"), F.lower(clean("field_type")).alias("kind"),
        F.when(F.col("total_rows") > 0, F.struct(F.col("total_rows").cast("bigint").alias("rows"), (F.col("non_null_rows") / F.col("total_rows")).alias("share"))).alias("count"),
    ).na.drop(subset=["feed", "table_name", "load_no", "name"])
    one = named.groupBy("feed", "table_name", "load_no", "name").agg(F.min("kind").alias("kind"), F.max("count").alias("count"))
    return one.select("feed", "table_name", "load_no", "name", "kind", "count.share", "count.rows")


def schema_changes(fields: DataFrame) -> DataFrame:
    """``feed, load_no, table_name, field_name, prev_field_name, change_kind`` between deliveries.

    ``fields`` as :func:`fields_of_loads` gives it; compared is with the feed's last delivery of the table.
    Each field stands once in its load and once, as the old state, in the table's next load; one aggregate
    brings both together.  The window carries one row per delivery.  Types that are missing change
    nothing; the first delivery gives no change; the fewer rows stand behind a share, the less it says
    about renames.
    """
    ship(fields.sparkSession)
    place = ["feed", "table_name", "load_no"]
    w = Window.partitionBy("feed", "table_name").orderBy("load_no")
    deliveries = fields.select(*place).distinct().withColumn("next_load", F.lead("load_no").over(w)).withColumn("first", F.lag("load_no").over(w).isNull())
    known = fields.join(deliveries, place)
    both = F.explode(F.array(F.struct(F.col("load_no").alias("at"), F.lit(True).alias("new")), F.struct(F.col("next_load").alias("at"), F.lit(False).alias("new"))))
    state = F.struct("name", "kind", "share", "rows")
    states = known.select("feed", "table_name", "name", state.alias("state"), "first", both.alias("b")).filter(F.col("b.at").isNotNull() & ~(F.col("b.new") & F.col("first")))
    compared = states.groupBy("feed", "table_name", F.col("b.at").alias("load_no"), "name").agg(
        F.max(F.when(F.col("b.new"), F.col("state"))).alias("now"), F.max(F.when(~F.col("b.new"), F.col("state"))).alias("was")
    )
    change = (
        F.when(F.col("was").isNull(), F.lit("added")).when(F.col("now").isNull(), F.lit("removed")).when(F.col("was.kind") != F.col("now.kind"), F.lit("retyped"))
    )
    # what stays matters only where it holds a tree together
    some = compared.withColumn("change", change).filter(F.col("change").isNotNull() | F.contains("name", F.lit(".")))
    listed = some.groupBy(*place).agg(
        F.collect_list(F.when(F.col("change") == "added", F.col("now"))).alias("added"),
        F.collect_list(F.when(F.col("change") == "removed", F.col("was"))).alias("removed"),
        F.collect_list(F.when(F.col("change") == "retyped", F.col("now"))).alias("retyped"),
        F.collect_list(F.when(F.col("change").isNull() | (F.col("change") == "retyped"), F.col("name"))).alias("kept"),
    )

    def plainly(col: str, kind: str):
        return F.transform(col, lambda f: F.struct(f["name"].alias("field_name"), F.lit("").alias("prev_field_name"), F.lit(kind).alias("change_kind")))

    two_sided = (F.size("added") > 0) & (F.size("removed") > 0)
    scripted = listed.filter(two_sided).select(*place, "added", "removed", "kept").mapInPandas(_scripts, f"feed string, table_name string, load_no bigint, c {_CHANGE}")
    one_sided = F.when(two_sided, plainly("retyped", "retyped")).otherwise(F.concat(plainly("added", "added"), plainly("removed", "removed"), plainly("retyped", "retyped")))
    return listed.select(*place, one_sided.alias("c")).unionByName(scripted).select("feed", "load_no", "table_name", F.explode("c").alias("c")).select(
        "feed", "load_no", "table_name", "c.field_name", "c.prev_field_name", "c.change_kind"
    )


def _scripts(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    def known(x):
        return None if x is None or x != x else x

    def fields(rows) -> list[Field]:
        return [Field(r["name"], r["kind"], known(r["share"]), known(r["rows"])) for r in rows]

    for batch in batches:
        out = []
        for added, removed, kept in zip(batch["added"], batch["removed"], batch["kept"], strict=True):
            stay = [Field(n) for n in kept]
            out.append(
                [
                    {
                        "field_name": e.old if e.kind == "removed" else e.new,
                        "prev_field_name": e.old if e.kind in ("renamed", "moved") else "",
                        "change_kind": "renamed" if e.kind == "moved" else e.kind,
                    }
                    for e in edit_script(fields(removed) + stay, fields(added) + stay)
                ]
            )
        yield pd.DataFrame({"feed": batch["feed"], "table_name": batch["table_name"], "load_no": batch["load_no"], "c": out})


# --------------------------------------------------------------------------- projections


def projection(source: Mapping[str, str], script: Iterable[Edit], target: Mapping[str, str]) -> list:
    """Select list that turns a file of schema ``source`` into ``target`` under the script from source to target.

    Names map to types.  Renamed and moved fields are read from their old place, added ones are NULL, removed
    ones are left out and retyped ones are cast (what does not read as the new type becomes NULL).
    """
    place = {e.new: e.old for e in script if e.kind in ("renamed", "moved")}
    out = []
    for name, kind in target.items():
        was = place.get(name, name)
        value = F.col(".".join(f"`{p}`" for p in was.split("."))).try_cast(kind) if was in source else F.lit(None).cast(kind)
        out.append(value.alias(name))
    return out


def unify(frames: Iterable[DataFrame]) -> tuple[DataFrame, list[tuple[int, Edit]]]:
    """Read frames of drifting schemas into one table of the last one's schema, with each change reported.

    Frames are in the order of delivery; the report gives the number of the frame that brought the change.
    Scripts between neighbours are composed, so a field renamed twice is still found.  Plans only: no data
    is read to compare schemas.
    """
    frames = list(frames)
    schemas = [{f.name: f.dataType.simpleString() for f in df.schema.fields} for df in frames]
    target = schemas[-1]
    report: list[tuple[int, Edit]] = []
    steps: list[dict[str, str]] = []
    for i in range(1, len(schemas)):
        script = edit_script([Field(n, t) for n, t in schemas[i - 1].items()], [Field(n, t) for n, t in schemas[i].items()])
        report += [(i, e) for e in script]
        steps.append({e.new: e.old for e in script if e.kind in ("renamed", "moved")})
    parts = []
    for i, df in enumerate(frames):
        place: dict[str, str] = {}
        for name in target:
            was: str | None = name
            for k in range(len(frames) - 2, i - 1, -1):
                was = steps[k].get(was, was if was in schemas[k] else None) if was is not None else None
            if was is not None and was in schemas[i]:
                place[name] = was
        script = [Edit("renamed", n, o) for n, o in place.items() if n != o]
        known = {n: t for n, t in schemas[i].items() if n in place.values()}
        parts.append(df.select(*projection(known, script, target)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, report
