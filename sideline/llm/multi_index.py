"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm.components import components
from sideline.llm.vectors import matrix, usable


def unit(rows, width: int) -> np.ndarray:
    x = matrix(rows, width)
    # scaled by the largest component first, so that no square overflows or vanishes
    x /= np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def codebook(x: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centres of the rows of ``x``, started from rows spread evenly over it."""
    centres = np.unique(x, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(size, len(centres))).astype(int)]
    for _ in range(rounds):
        near = ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


class Grid:
    """The product of two codebooks over the halves of a vector; cell u * K2 + v."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books, self.half = (first, second), first.shape[1]

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        parts = x[:, : self.half], x[:, self.half :]
        return [(p**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * p @ b.T for p, b in zip(parts, self.books, strict=True)]

    def visits(self, x: np.ndarray, count: int) -> np.ndarray:
        """The first ``count`` cells of each row by multi-sequence order, its own cell first.

        Both halves' centres are sorted by distance; among the nearest ``count`` sums only pairs of
        positions (i, j) with (i + 1)(j + 1) <= count can occur, so only those are formed.
        """
        d1, d2 = self.distances(x)
        o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
        count = min(count, d1.shape[1] * d2.shape[1])
        i, j = np.array([(a, b) for a in range(d1.shape[1]) for b in range(d2.shape[1]) if (a + 1) * (b + 1) <= count]).T
        rows = np.arange(len(x))[:, None]
        u, v = o1[:, i], o2[:, j]
        order = np.argsort(d1[rows, u] + d2[rows, v], axis=1, kind="stable")[:, :count]
        return (u * d2.shape[1] + v)[rows, order].astype(np.int32)

    def least_squares(self, x: np.ndarray) -> list[np.ndarray]:
        """By half: a lower bound of each row's squared distance to whatever has a centre as its nearest.

        What is nearest to centre u lies on u's side of the plane between u and any other centre a, and
        the row is (|x - u|^2 - |x - a|^2) / (2 |u - a|) away from that plane. Centres that nearly
        coincide give no bound, as rounding would outweigh it.
        """
        out = []
        for d, book in zip(self.distances(x), self.books, strict=True):
            apart = np.sqrt(np.maximum(((book[:, None, :] - book[None, :, :]) ** 2).sum(2), 0.0))
            low = np.zeros_like(d)
            for a in range(len(book)):
                far = np.where(apart[a] > 1e-3, 2 * apart[a], np.inf)
                np.maximum(low, (d - d[:, a : a + 1]) / far, out=low)
            out.append(low**2)
        return out


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node connected to each of ``n`` nodes by the links (a[i], b[i])."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == old).all():
            return label


def _groups(cells: np.ndarray, counts: np.ndarray, block: int) -> tuple[dict[int, tuple[int, int]], np.ndarray, np.ndarray]:
    """Cells put together in groups of at most ``block`` entries; a larger cell is several groups.

    Returns (first group, number of groups) by cell, and the cells of all groups one after another
    with the place where each group starts.
    """
    home, members, starts, held = {}, [], [], block
    for cell, n in zip(cells.tolist(), counts.tolist(), strict=True):
        parts = -(-n // block)
        if parts > 1 or held + n > block:
            for _ in range(parts):
                starts.append(len(members))
                members.append(cell)
            held = block if parts > 1 else n
        else:
            members.append(cell)
            held += n
        home[cell] = len(starts) - parts, parts
    return home, np.array(members, np.int64), np.array(starts, np.int64)


def near_duplicates(
    data: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
    recall: float = 1.0, sample: int = 4096, probes: int = 0, cell_rows: int = 64,
    most_codes: int = 128, block: int = 4096,
) -> DataFrame:
    """All vectors linked by cosine >= ``threshold``, and their components.

    Equal vectors are one entry with a count. The vectors' halves get independent codebooks, fitted
    on ``sample`` entries (those with the smallest hashes, a fixed number); the pairs of codes form
    a grid of about one cell per ``cell_rows`` entries, up to ``most_codes`` squared. Every entry is
    stored in one cell, and cells are put together in groups of at most ``block`` entries.

    Unit vectors at the threshold are sqrt(2 - 2 threshold) apart. An entry meets another group unless
    lower bounds of its distance to every cell of that group exceed this, so no link can be missed,
    however rare links are and whatever group has most of them. ``recall`` and ``probes`` are of a
    former, measured number of cells; they change nothing. Every pair that meets is verified by its
    cosine in double precision, so no link is below the threshold.

    Two groups meet in one tile, which each linked pair shares exactly once; a tile has at most
    ``block`` entries a side, so a cell that holds a third of all entries is many tasks of bounded
    memory. A tile gives sums per entry and a spanning forest of its links, never the pairs. Where
    vectors have no clusters the bounds exclude little: then every entry is sent to every group and
    the pairs compared grow with the square of the table.

    Returns one row per row of ``data``: id, n_links (other rows linked directly), component_id
    (smallest id reachable) and kept (the row is the smallest of its component). Vectors that are
    null, zero or hold null or non-finite components, and rows with a null id, link with nothing (a
    null id is its own component and is kept); shorter vectors count as filled up with zeros. Other
    columns are not read.
    """
    rows = data.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    fits = F.col("id").isNotNull() & usable(F.col("vec")) & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    entries = written(
        rows.filter(fits).groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult")), "vectors")
    n, width = entries.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    width = max(2, width or 2)
    width += width % 2
    some = [r.vec for r in entries.orderBy(F.xxhash64("rep")).limit(sample).collect()]
    fit = unit(some or [[1.0]], width)
    codes = max(1, min(most_codes, round(math.sqrt(max(1, n / cell_rows)))))
    grid = Grid(codebook(fit[:, : width // 2], codes), codebook(fit[:, width // 2 :], codes))
    kind = entries.schema["vec"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["rep", "mult", "vec"]].assign(cell=grid.visits(unit(pdf["vec"], width), 1)[:, 0])

    coded = written(entries.mapInPandas(place, f"rep long, mult long, vec {kind}, cell int"), "cells")
    # a row per cell of the grid at most
    stored = coded.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").toPandas()
    groups, members, starts = _groups(stored["cell"].to_numpy(), stored["n"].to_numpy(), block)
    far = 2 - 2 * threshold + 1e-9

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each entry with its own group and all groups that may hold a link of it."""
        u, v = np.divmod(members, len(grid.books[1]))
        for pdf in batches:
            first, parts = np.array([groups[c] for c in pdf["cell"]], np.int64).reshape(-1, 2).T
            home = first + pdf["deal"].to_numpy() % parts
            met = []
            for at in range(0, len(pdf), 128):
                low = grid.least_squares(unit(pdf["vec"].iloc[at : at + 128], width))
                near = np.logical_or.reduceat(low[0][:, u] + low[1][:, v] <= far, starts, axis=1)
                near[np.arange(len(near)), home[at : at + 128]] = True
                met += [np.flatnonzero(r).astype(np.int32) for r in near]
            yield pdf[["rep", "mult", "vec"]].assign(home=home.astype(np.int32), met=met)

    dealt = coded.withColumn("deal", F.pmod(F.xxhash64("rep"), F.lit(2**31 - 1)))
    reaching = dealt.mapInPandas(reach, f"rep long, mult long, vec {kind}, home int, met array<int>")
    tiles = reaching.select("rep", "mult", "vec", "home", F.explode("met").alias("other")).select(
        "rep", "mult", "vec", "home", F.least("home", "other").alias("lo"), F.greatest("home", "other").alias("hi"))

    def solve(key: tuple[int, int], pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable")
        rep, mult, home = (pdf[c].to_numpy() for c in ("rep", "mult", "home"))
        down, across = np.flatnonzero(home == key[0]), np.flatnonzero(home == key[1])
        links, label = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
        x = unit(pdf["vec"], width) if len(down) and len(across) else None
        for at in range(0, len(down) if len(across) else 0, 512):
            part = down[at : at + 512]
            i, j = np.nonzero(x[part] @ x[across].T >= threshold)
            i, j = part[i], across[j]
            real = rep[i] != rep[j]
            if key[0] == key[1]:
                real &= i < j
            i, j = i[real], j[real]
            if len(i):
                np.add.at(links, i, mult[j])
                np.add.at(links, j, mult[i])
                label = _roots(np.concatenate([np.arange(len(pdf)), i]), np.concatenate([label, j]), len(pdf))
        linked = links > 0
        return pd.DataFrame({"rep": rep[linked], "links": links[linked], "root": rep[label[linked]]})

    met = written(tiles.groupBy("lo", "hi").applyInPandas(solve, "rep long, links long, root long"), "met")
    found = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    answer = (
        entries.join(links, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("vec", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    linked = rows.filter(fits).join(answer, "vec").select("id", "n_links", "component_id")
    alone = rows.filter(~fits).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
