"""Links among the texts of one group, in one task: runs of words numbered exactly, rare runs first, classes joined as links are found."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
import pandas as pd
import zstandard

from lakeload.llm.wordhash import valid_starts

AT_ONCE = 1 << 19      # runs of whole groups that are numbered at once
LOOKS = 64             # holders of a text's runs that are looked up, for each text of the group; the rest is bounded


def run_numbers(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's multiset of runs as a set of numbers (run and occurrence), which are equal just where those are; and where each text's
    numbers start (one more entry at the end). Words themselves are numbered, not hashed, so nothing collides. No text may be empty."""
    numbers: defaultdict = defaultdict(count().__next__)
    fill = numbers[None]                                  # a text of fewer words than a run is one run
    own = []
    for text in texts:
        words = text.split()
        own.append(np.fromiter(map(numbers.__getitem__, words + [None] * (width - len(words))), np.int64))
    assert fill == 0
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int64)
    words = np.concatenate(own)
    starts = valid_starts(bounds, width)
    run = words[starts]
    for i in range(1, width):                             # runs of two words, of three, and so on
        run = np.unique(run * len(numbers) + words[starts + i], return_inverse=True)[1]
    counts = np.diff(bounds) - width + 1
    many = int(run.max()) + 1
    both = np.sort(np.repeat(np.arange(len(texts)), counts) * many + run)
    at = np.arange(len(both))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], both[1:] != both[:-1])), at, 0))
    return both % many + (at - first) * many, np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all spans, one after the other."""
    ahead = np.cumsum(lengths) - lengths
    return np.repeat(starts - ahead, lengths) + np.arange(lengths.sum())


def joining_links(numbers: np.ndarray, sizes: np.ndarray, label: np.ndarray, turn: np.ndarray, main: int, least: float) -> list[tuple[int, int]]:
    """Links at the likeness ``least`` or more that join the classes of a group's texts, each two classes at the time. ``numbers`` holds the
    texts' run numbers one after the other, the head's first, ``sizes`` how many each has, ``label`` the classes known so far.

    Only texts that have a ``turn`` meet the others: all that are not of the class ``main`` have, here or in another task. They meet by
    their runs beyond the head, rarest in the group first: two linked texts share at least ``lacking`` of these, as within the head
    they share no more than either has of it. This rules out most texts, and what is left is counted in full.
    """
    n = len(sizes)
    label = label.copy()
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    row = np.repeat(np.arange(n), sizes)
    head = np.sort(numbers[:sizes[0]])
    inside = head[np.minimum(np.searchsorted(head, numbers), len(head) - 1)] == numbers
    shared = np.bincount(row[inside], minlength=n)
    alike = shared / (sizes + sizes[0] - shared) >= least
    links = [(0, int(x)) for x in np.flatnonzero(alike & (label != label[0]))]
    if len(links) == n - 1:
        return links
    for _, x in links:
        if label[x] != label[0]:
            old, new = (label[x], label[0]) if label[x] != main else (label[0], label[x])
            label[label == old] = new
    runs = np.unique(numbers, return_inverse=True)[1]
    marked = np.zeros(runs.max() + 1, dtype=bool)
    # the texts that have each run beyond the head
    beyond, holder = runs[~inside], row[~inside]
    often = np.bincount(beyond, minlength=len(marked))
    holder = holder[np.argsort(beyond, kind="stable")]
    place = np.cumsum(often) - often
    for x in np.flatnonzero(turn):
        if label[x] == main:
            continue
        own = runs[bounds[x]:bounds[x + 1]]
        outer = own[~inside[bounds[x]:bounds[x + 1]]]
        lacking = np.ceil(least / (1 + least) * (sizes[x] + sizes) - 1e-6) - np.minimum(shared, shared[x])
        may = (label != label[x]) & (sizes >= least * sizes[x] - 1e-6) & (sizes[x] >= least * sizes - 1e-6) & (lacking <= len(outer))
        if not may.any():
            continue
        outer = outer[np.argsort(often[outer], kind="stable")]
        looked = outer[:np.searchsorted(np.cumsum(often[outer]), LOOKS * n, "right")]
        met = np.bincount(holder[spans(place[looked], often[looked])], minlength=n)
        found = np.flatnonzero(may & (met >= lacking - (len(outer) - len(looked))))
        if not len(found):
            continue
        marked[own] = True
        common = np.add.reduceat(marked[runs[spans(bounds[found], sizes[found])]], np.cumsum(sizes[found]) - sizes[found], dtype=np.int64)
        marked[own] = False
        found = found[common / (sizes[found] + sizes[x] - common) >= least]
        # one link for each other class
        for other, at in zip(*np.unique(label[found], return_index=True)):
            links.append((int(x), int(found[at])))
            old, new = (other, label[x]) if other != main else (label[x], other)
            label[label == old] = new
    return links


def group_links(width: int, least: float):
    """For rows (head, i, j, node, label, main, turn, size, packed) that come group by group, by (head, i, j), the head's own row first:
    links (a, b) that join each group's classes."""

    def linked(held: list[tuple]) -> pd.DataFrame:
        undo = zstandard.ZstdDecompressor()
        packed = {r[3]: r[8] for r in held}               # a text in several groups is numbered once
        at = {node: i for i, node in enumerate(packed)}
        numbers, bounds = run_numbers([undo.decompress(z) for z in packed.values()], width)
        sizes, out = np.diff(bounds), []
        for _, rows in groupby(held, key=lambda r: r[:3]):
            _, _, _, nodes, labels, mains, turns, _, _ = zip(*rows)
            texts = np.array([at[x] for x in nodes])
            links = joining_links(numbers[spans(bounds[texts], sizes[texts])], sizes[texts], np.array(labels), np.array(turns), mains[0], least)
            out += [(nodes[a], nodes[b]) for a, b in links]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        runs = 0
        for pdf in batches:
            for r in zip(*(pdf[c].tolist() for c in ("head", "i", "j", "node", "label", "main", "turn", "size", "packed"))):
                if runs >= AT_ONCE and r[:3] != held[-1][:3]:
                    yield linked(held)
                    held, runs = [], 0
                held.append(r)
                runs += r[7]
        if held:
            yield linked(held)
    return run
