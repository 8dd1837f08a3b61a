"""Documents packed into sequences of fixed capacity by bin completion.

Documents are spread by hash over groups of about GROUP, and each group is
packed on its own, so packing needs small shuffles of (id, length) only; equal
rows are counted first and then numbered, so that copies spread like others.  Within a
group the incumbent is best-fit decreasing.  Where it uses more bins than the
lower bound, branch and bound tries to save one: the largest document left opens
a bin, the undominated fillings of what it leaves are made one at a time, fullest
first, and each is descended into before the next is made; a branch ends when
its waste exceeds what a packing with one bin fewer may waste.  NODES bounds the
fillings that a group looks at (steps towards one count as a part of it); when
they are used up the best packing so far stands, which is never worse than best
fit.

A document longer than the capacity is cut into pieces of the capacity, bins of
their own, and a rest that is packed like any document: nothing is dropped.

Defined results: null and empty texts have nothing to pack and are in no bin;
repeated rows are packed each, however many; a null id stays null; of equal
sizes the lower id is placed first, null last.  Sizes are characters.  Ids must
be integers or castable to them.  Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import cut

CAPACITY, GROUP, NODES = 8192, 512, 3000
#: What a step towards a filling takes of NODES.
STEP = 0.01


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; places in ``sizes``, which falls."""
    bins, room = [], []  # room: sorted (free, bin)
    for i, s in enumerate(sizes):
        k = bisect_left(room, (s, -1))
        if k == len(room):
            insort(room, (capacity - s, len(bins)))
            bins.append([i])
        else:
            free, b = room.pop(k)
            bins[b].append(i)
            insort(room, (free - s, b))
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Martello and Toth's second bound; ``sizes`` falls."""
    a = np.asarray(sizes)[::-1]
    ends, n = np.concatenate([[0], np.cumsum(a)]), len(a)
    best = -(-int(ends[-1]) // capacity)
    for k in {0, *(int(x) for x in a if 2 * x <= capacity)}:
        big, half, low = np.searchsorted(a, capacity - k, "right"), np.searchsorted(2 * a, capacity, "right"), np.searchsorted(a, k)
        middle, small = int(ends[big] - ends[half]), int(ends[half] - ends[min(low, half)])
        best = max(best, (n - big) + (big - half) + max(0, -(-(small - ((big - half) * capacity - middle)) // capacity)))
    return int(best)


def fillings(sizes: list[int], room: int, waste: int, budget: list[float]):
    """Undominated sets of places in ``sizes`` (which falls) that leave at most ``waste`` of ``room``.

    They come as they are found: those that leave nothing, then those that leave
    at most 1, 3, 7 and so on; larger documents first within each of these.
    """
    n, falling = len(sizes), [-s for s in sizes]
    ends = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ends[i] = ends[i + 1] + sizes[i]

    def dominated(chosen: list[int], slack: int) -> bool:
        # One left out still fits, or some documents of the filling could give way to one left out that is as large and still fits.
        fit = bisect_left(falling, -slack)
        if n - fit > sum(i >= fit for i in chosen):
            return True
        sums = 1  # bit x: some of the filling add up to x
        for i in chosen:
            sums |= sums << sizes[i]
        inside, own = set(chosen), {sizes[i] for i in chosen}
        seen = 0
        for i in range(bisect_left(falling, -room), n):
            y = sizes[i]
            if y == seen or i in inside:
                continue
            seen = y
            least = max(y - slack, 1)
            give = sums >> least & (1 << (y - least + 1)) - 1
            if y in own:
                give &= ~(1 << y - least)  # an equal document is no gain
            if give:
                return True
        return False

    low, high = 0, 0
    while low <= waste:
        chosen: list[int] = []
        i, left = 0, room
        while budget[0] > 0:
            budget[0] -= STEP
            j = bisect_left(falling, -left, i)
            if j < n and left >= low and left - ends[j] <= high:
                chosen.append(j)
                left -= sizes[j]
                i = j + 1
                continue
            if j == n and low <= left <= high:
                budget[0] -= 1
                if not dominated(chosen, left):
                    yield left, chosen[:]
            if not chosen:
                break
            j = chosen.pop()
            left += sizes[j]
            i = bisect_right(falling, falling[j], j)  # equal documents are alike
        low, high = high + 1, min(2 * high + 1, waste)


def complete(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """The bins of places in ``sizes``, which falls and is at most the capacity."""
    best = best_fit(sizes, capacity)
    least = lower_bound(sizes, capacity) if sizes else 0
    budget = [float(nodes)]

    def search(left: list[int], waste: int):
        """left: places still to pack; waste: what the target leaves to waste."""

        def ways(left: list[int], waste: int):
            return left, waste, fillings([sizes[i] for i in left[1:]], capacity - sizes[left[0]], waste, budget)

        done, path = [], [ways(left, waste)]
        while path:
            left, waste, found = path[-1]
            free, chosen = next(found, (0, None))
            del done[len(path) - 1 :]
            if chosen is None:
                path.pop()
                continue
            took = {0, *(c + 1 for c in chosen)}
            done.append([left[i] for i in sorted(took)])
            rest = [x for i, x in enumerate(left) if i not in took]
            if not rest:
                return done
            path.append(ways(rest, waste - free))
        return None

    while len(best) > least and budget[0] > 0:
        waste = (len(best) - 1) * capacity - sum(sizes)
        if waste < 0:
            break
        got = search(list(range(len(sizes))), waste)
        if got is None or len(got) >= len(best):
            break
        best = got
    return best


SCHEMA = pa.schema([(n, pa.int64()) for n in ("bin_id", "place", "doc_id", "piece", "start_char", "n_chars", "bin_chars")])
DDL = ", ".join(f"{n} bigint" for n in SCHEMA.names)


def _pack(capacity: int, nodes: int):
    def run(table: pa.Table) -> pa.Table:
        g, rows, bin_, rest = table["grp"][0].as_py(), [], 0, []
        for doc_id, n in sorted(zip(table["doc_id"].to_pylist(), table["n"].to_pylist()), key=lambda d: (-(d[1] % capacity), d[0] is None, d[0])):
            for k in range(n // capacity):
                rows.append((g << 24 | bin_, 0, doc_id, k, k * capacity, capacity, capacity))
                bin_ += 1
            if n % capacity:
                rest.append((doc_id, n // capacity, n - n % capacity, n % capacity))
        for b in complete([r[3] for r in rest], capacity, nodes):
            used = sum(rest[i][3] for i in b)
            rows += [(g << 24 | bin_, p, *rest[i], used) for p, i in enumerate(b)]
            bin_ += 1
        return pa.table([pa.array(x, pa.int64()) for x in zip(*rows)], schema=SCHEMA) if rows else SCHEMA.empty_table()

    return run


def best_fit_packing(df: DataFrame, capacity: int = CAPACITY, group: int = GROUP, nodes: int = NODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin_id, place, doc_id, piece, start_char, n_chars, bin_chars) of every piece of every document."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.length(F.col(text_col).cast("string")).cast("bigint").alias("n")).where("n > 0")
    alike = cut(docs.groupBy("doc_id", "n").agg(F.count("*").alias("copies")))
    groups = alike.agg(F.greatest(F.lit(1), F.ceil(F.sum("copies") / group)).alias("groups"))
    many = groups.first()[0] or 1
    # Two steps, so that no row holds a list as long as the copies are many.
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 4096))).alias("block")
    one = F.explode(F.sequence(F.lit(0), F.least(F.col("copies") - 4096 * F.col("block"), F.lit(4096)) - 1)).alias("copy")
    each = alike.select("doc_id", "n", "copies", block).select("doc_id", "n", "block", one)
    grouped = each.select("doc_id", "n", F.pmod(F.xxhash64("doc_id", "n", "block", "copy"), F.lit(many)).alias("grp"))
    return grouped.groupBy("grp").applyInArrow(_pack(capacity, nodes), DDL)
