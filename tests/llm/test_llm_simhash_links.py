"""Links of fingerprints against all pairs, in groups of every size."""

import numpy as np
import pytest
from bandwright.llm import simhash
from bandwright.llm.simhash import linked_fingerprints, spanning_links
from hypothesis import given, settings, strategies as st


def _labels(prints, bits):
    """Smallest index of each component, over all pairs."""
    label = np.arange(len(prints))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits
    while True:
        least = np.where(near, label[None, :], len(prints)).min(axis=1)
        if (least == label).all():
            return label
        label = least


def _cluster(draw, n, flips, centre):
    out = []
    for _ in range(n):
        value = int(centre)
        for bit in draw.choice(64, draw.integers(0, flips + 1), replace=False):
            value ^= 1 << int(bit)
        out.append(value)
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([3, 40, 64]), st.integers(0, 5), st.booleans())
def test_spanning_links_join_what_all_links_join(seed, at, bits, small):
    draw = np.random.default_rng(seed)
    parts = []
    for key in range(4):
        centre = draw.integers(0, 1 << 63)
        values = np.unique(np.array(_cluster(draw, int(draw.integers(1, 40)), 6, centre), np.uint64))
        parts.append((np.full(len(values), key), values))
    keys, prints = (np.concatenate(x) for x in zip(*parts))
    before = simhash._SMALL, simhash._ROWS
    simhash._SMALL, simhash._ROWS = (64, 64) if small else (2, 5)
    try:
        found = spanning_links(prints, np.full(len(keys), at, np.int32), keys, bits)
    finally:
        simhash._SMALL, simhash._ROWS = before
    side = (prints >> np.uint64(at)) & np.uint64(1) if at < 64 else None
    near = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits) & (keys[:, None] == keys[None, :])
    if side is not None:
        near &= side[:, None] != side[None, :]
    assert all(near[i, j] for i, j in found) and len(found) < len(prints)
    joined = np.zeros_like(near)
    for i, j in found:
        joined[i, j] = joined[j, i] = True
    for links in (near, joined):
        np.fill_diagonal(links, True)

    def label(links):
        out = np.arange(len(prints))
        while True:
            least = np.where(links, out[None, :], len(prints)).min(axis=1)
            if (least == out).all():
                return out.tolist()
            out = least

    assert label(near) == label(joined)


@pytest.mark.parametrize("most, bits", [(4096, 4), (8, 4), (2, 5), (8, 0), (3, 3)])
def test_components_of_dense_clusters(spark, monkeypatch, most, bits):
    monkeypatch.setattr(simhash, "MOST_UNDER_KEY", most)
    draw = np.random.default_rng(most + bits)
    values = [0, (1 << 64) - 1]
    for n, flips in ((300, 3), (60, 9), (200, 6), (40, 14), (200, 64)):
        values += _cluster(draw, n, flips, draw.integers(0, 1 << 63, dtype=np.uint64))
    prints = np.unique(np.array(values, np.uint64))
    want = _labels(prints, bits)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    got = {r.node: r.label for r in linked_fingerprints(frame, bits).collect()}
    place = {int(x): i for i, x in enumerate(prints.view(np.int64))}
    groups = {}
    for node, label in got.items():
        groups.setdefault(label, set()).add(place[node])
    wanted = {}
    for i, label in enumerate(want.tolist()):
        wanted.setdefault(label, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in wanted.values() if len(g) > 1)


def test_rows_grow_with_the_input(spark):
    """A cluster of near fingerprints comes out as fewer links than it has index rows, whatever its size."""
    draw = np.random.default_rng(7)
    centre = draw.integers(0, 1 << 63)
    for n in (500, 2000):
        prints = np.unique(np.array(_cluster(draw, n, 8, centre), np.uint64))
        rows = []
        for at in range(67):
            low, high = next(b for b in simhash._bounds(64) if at >= 64 and b == simhash._bounds(64)[at - 64] or b[0] <= at < b[1])
            segment = (prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            segment = segment if at >= 64 else segment & ~np.uint64(1 << (at - low))
            order = np.argsort(segment, kind="stable")
            rows.append((np.full(len(prints), at, np.int32), segment[order].astype(np.int64), prints[order]))
        at, keys, all_prints = (np.concatenate(x) for x in zip(*rows))
        pairs = int((np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4).sum() - len(prints)) // 2
        links = spanning_links(all_prints, at, keys, 4)
        ends = {frozenset((int(all_prints[i]), int(all_prints[j]))) for i, j in links}
        assert len(ends) <= 12 * n and (n < 2000 or len(ends) < pairs)
