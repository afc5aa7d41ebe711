"""One surviving record per duplicate group by token-level consensus.

The values of a column within a group are aligned token by token: the heaviest
value is the centre, and every other value joins the alignment on it (a
progressive alignment along a star tree, gaps once made stay).  The tokens of
each aligned column vote with their values' weights, the winners make the
consensus, and the existing value closest to it survives.

Plan: values are pre-aggregated to distinct (group, column, value) with
map-side combine.  A value is aligned where it lies and sends only what differs
from the centre as (position, token, weight); votes are a combinable sum, what
the centre keeps is the group's total less that.  So no task ever holds a group
or its tokens, however many distinct values it has, and no result depends on
how rows are spread.  Only groups whose vote overrules the centre measure
distances, by a combinable minimum.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Mapping, Sequence
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources.tables import materialise

GAP = ""
#: A difference from the centre: (i, 0, token) in place of its token i, (i, k, token) the k-th one put before it.
Edit = tuple[int, int, str]
_EDITS = "array<struct<pos:int,ins:int,token:string>>"
_TOKEN = re.compile(r"\w+|[^\w\s]|\s+")


def tokens(value: str) -> list[str]:
    return _TOKEN.findall(value)


def _below(up: Sequence[int], i: int, a: Sequence[str], b: Sequence[str], band: int) -> array:
    """Row ``i`` of the edit distance table, cells at most ``band`` off the diagonal."""
    first, up_first, up_last = max(0, i - band), max(0, i - 1 - band), min(len(b), i - 1 + band)
    row = array("q")
    for j in range(first, min(len(b), i + band) + 1):
        if j == 0:
            row.append(i)
            continue
        cost = up[j - 1 - up_first] + (a[i - 1] != b[j - 1])
        if j <= up_last:
            cost = min(cost, up[j - up_first] + 1)
        if j > first:
            cost = min(cost, row[-1] + 1)
        row.append(cost)
    return row


def _trim(a: Sequence[str], b: Sequence[str]) -> tuple[int, int]:
    short, lead, tail = min(len(a), len(b)), 0, 0
    while lead < short and a[lead] == b[lead]:
        lead += 1
    while tail < short - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return lead, tail


def _banded(a: Sequence[str], b: Sequence[str]) -> tuple[int, int, dict[int, array]]:
    """Distance, the band that proves it, and every ``isqrt``-th row: the band grows until the distance lies within."""
    step, band = isqrt(len(a)) + 1, max(1, abs(len(a) - len(b)))
    while True:
        row = array("q", range(min(len(b), band) + 1))
        kept = {0: row}
        for i in range(1, len(a) + 1):
            row = _below(row, i, a, b, band)
            if i % step == 0:
                kept[i] = row
        if row[-1] <= band:
            return row[-1], band, kept
        band *= 2


def token_distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Edit distance in tokens."""
    lead, tail = _trim(a, b)
    return _banded(a[lead : len(a) - tail], b[lead : len(b) - tail])[0]


def align(centre: Sequence[str], value: Sequence[str]) -> list[Edit]:
    """The cheapest edits that turn ``centre`` into ``value``; of equally cheap ones a replacement before a gap.

    Time grows with length times distance, memory with the root of the length; all lengths go the same way.
    """
    lead, tail = _trim(centre, value)
    a, b = centre[lead : len(centre) - tail], value[lead : len(value) - tail]
    _, band, kept = _banded(a, b)
    step, block = isqrt(len(a)) + 1, dict(kept)
    path: list[tuple[int, int]] = []  # (row, column) before each step, from the end
    moves: list[str] = []
    i, j = len(a), len(b)

    def cell(r: int, c: int) -> int | None:
        at = c - max(0, r - band)
        return block[r][at] if 0 <= at < len(block[r]) else None

    while i or j:
        if i and (i not in block or i - 1 not in block):
            block = dict(kept)
            for k in range((i - 1) // step * step + 1, i + 1):
                block[k] = _below(block[k - 1], k, a, b, band)
        here = cell(i, j)
        diagonal = cell(i - 1, j - 1) if i and j else None
        above = cell(i - 1, j) if i else None
        if diagonal is not None and here == diagonal + (a[i - 1] != b[j - 1]):
            move, i, j = "d", i - 1, j - 1
        elif above is not None and here == above + 1:
            move, i = "a", i - 1
        else:
            move, j = "l", j - 1
        moves.append(move)
        path.append((i, j))
    out: list[Edit] = []
    put = 0
    for move, (i, j) in zip(reversed(moves), reversed(path), strict=True):
        if move == "l":
            put += 1
            out.append((lead + i, put, b[j]))
            continue
        put = 0
        if move == "a":
            out.append((lead + i, 0, GAP))
        elif a[i] != b[j]:
            out.append((lead + i, 0, b[j]))
    return out


def apply_edits(centre: Sequence[str], edits: Iterable[Edit]) -> list[str]:
    """``centre`` with the edits done; an inserted column that lost against the gap is simply not among them."""
    put: dict[int, list[tuple[int, str]]] = {}
    for pos, ins, token in edits:
        put.setdefault(pos, []).append((ins, token))
    out: list[str] = []
    for i in range(len(centre) + 1):
        here = put.get(i, [])
        out += [t for k, t in sorted(here) if k]
        if i < len(centre):
            out.append(next((t for k, t in here if k == 0), centre[i]))
    return [t for t in out if t != GAP]


def _differences(centres: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([align(tokens(c), tokens(v)) for c, v in zip(centres, values, strict=True)], dtype=object)


def _distances(centres: pd.Series, won: pd.Series, values: pd.Series) -> pd.Series:
    out, known, wanted = [], None, []
    for c, e, v in zip(centres, won, values, strict=True):
        changes = [(x["pos"], x["ins"], x["token"]) for x in e]
        if known != (c, changes):
            known, wanted = (c, changes), apply_edits(tokens(c), changes)
        out.append(token_distance(tokens(v), wanted))
    return pd.Series(out, dtype="int64")


def survivors(
    df: DataFrame, group: Column, columns: Mapping[str, Column], *, weight: Column | None = None, rank: Column | None = None,
    pool: str = "sum", hot_share: float = 0.01,
) -> DataFrame:
    """``group_key, column_name, value, n_values, n_rows``: the surviving value of each column of each group.

    ``weight`` (whole numbers above 0, so that sums depend on no order) is a row's say, by default 1.
    With ``pool="sum"`` a value votes with the weight of all its rows, with ``"max"`` once, with that of
    its best row.  ``rank`` (anything that sorts) breaks ties: the centre is the heaviest, then the
    highest-ranked, then the highest value; a column keeps the centre's token unless another one has more
    weight; of equally close values the heavier, then the higher-ranked, then the higher one stands.

    Missing values (NULL) have no vote; a column with none gives no row; the empty text is a value.  Rows
    without a group are left out.  Repeated rows add votes.  Texts of any length are aligned whole.
    """
    if pool not in ("sum", "max"):
        raise ValueError("pool is sum or max")
    ship(df.sparkSession)
    names, keys = list(columns), ["g", "c"]
    weight, rank = (F.lit(1) if weight is None else weight), (F.lit(0) if rank is None else rank)
    wide = df.select(
        group.alias("g"), weight.cast("bigint").alias("w"), rank.alias("r"), *[columns[n].cast("string").alias(f"v{i}") for i, n in enumerate(names)]
    ).filter("g IS NOT NULL")
    pairs = wide.select("g", "w", "r", F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")) for i in range(len(names))])).alias("x"))
    values = materialise(
        pairs.select("g", "w", "r", "x.c", "x.v").filter("v IS NOT NULL").groupBy("g", "c", "v")
        .agg(F.count(F.lit(1)).alias("n"), (F.sum if pool == "sum" else F.max)("w").alias("w"), F.max("r").alias("r")),
        "values",
    )
    groups = materialise(
        values.groupBy(*keys).agg(
            F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_values"), F.sum("w").alias("total"), F.max(F.struct("w", "r", "v")).alias("best")
        ).select(*keys, "n_rows", "n_values", "total", F.col("best.v").alias("centre"), F.col("best.w").alias("held")),
        "groups",
    )
    # no column can be won against a centre that holds half of the weight, so only the other groups are aligned
    several = groups.filter("n_values > 1 AND 2 * held < total").select(*keys, "n_values", "total", "centre")
    all_values = several.agg(F.sum("n_values").alias("n")).first()["n"] or 0
    is_hot = F.col("n_values") >= F.lit(max(1.0, hot_share * all_values))

    def with_group(of: DataFrame) -> DataFrame:
        """Values with their group's row; at most 1 / hot_share groups are hot and broadcast, the others shuffle."""
        hot = F.broadcast(of.filter(is_hot))
        rest = values.join(hot.select(*keys), keys, "left_anti").join(of.filter(~is_hot), keys)
        return values.join(hot, keys).unionByName(rest)

    others = with_group(several).filter("v <> centre")
    edits = others.select(*keys, "total", "w", "r", F.explode(F.pandas_udf(_differences, _EDITS)("centre", "v")).alias("e"))
    votes = edits.groupBy(*keys, "e.pos", "e.ins", "e.token").agg(F.sum("w").alias("w"), F.max("r").alias("r"), F.max("total").alias("total"))
    columns_won = (
        votes.groupBy(*keys, "pos", "ins").agg(F.max(F.struct("w", "r", "token")).alias("best"), F.sum("w").alias("against"), F.max("total").alias("total"))
        .filter(F.col("best.w") > F.col("total") - F.col("against"))
    )
    # as long as the consensus: a column is here only if a token has more weight in it than the centre
    overruled = columns_won.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "ins", F.col("best.token").alias("token")))).alias("won"))
    near = with_group(several.join(overruled, keys)).withColumn("d", F.pandas_udf(_distances, "bigint")("centre", "won", "v"))
    closest = near.groupBy(*keys).agg(F.max(F.struct(-F.col("d"), "w", "r", "v"))["v"].alias("closest"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("c") + 1)
    # where the vote confirms the centre, the centre is the consensus
    return groups.join(closest, keys, "left").select(
        F.col("g").alias("group_key"), label.alias("column_name"), F.coalesce("closest", "centre").alias("value"), "n_values", "n_rows"
    )
