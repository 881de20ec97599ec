import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeflow.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_bins_hold_their_pieces(sizes):
    sizes = np.array(sizes, np.int64)
    caps = (16, 32, 64)
    bins, places, final = packing.pack(sizes, caps)
    for b in range(len(final)):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(places[own])]
        ends = places[own] + sizes[own]
        assert places[own[0]] == 0 and (places[own[1:]] == ends[:-1]).all()
        assert final[b] == min(c for c in caps if c >= ends[-1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_and_ties(sizes):
    """Each piece goes where least room is left, of bins with equal room to the one opened first."""
    sizes = np.array(sizes, np.int64)
    bins, places, _ = packing.pack(sizes, (64,))
    room = []
    for i in np.argsort(-sizes, kind="stable"):
        fitting = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        b = min(fitting)[1] if fitting else len(room)
        if not fitting:
            room.append(64)
        assert (bins[i], places[i]) == (b, 64 - room[b])
        room[b] -= sizes[i]


def test_close_to_the_volume():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 900, 5000)
    bins, _, final = packing.pack(sizes)
    assert sizes.sum() / final.sum() > 0.97


def test_documents(spark, documents):
    rows = [(1, "a b  c\n d", "en"), (2, "w " * 9000, "en"), (3, "", "en"), (None, None, None), (4, " \n ", "en"), (5, "x", "en"), (5, "x", "en")]
    rows += [(100 + i, "t " * (i * 37 % 700), "en") for i in range(60)]
    got = packing.pack_documents(documents(rows), shard_pieces=20).toPandas()
    want = {}
    for k, t, _ in rows:
        want[k] = want.get(k, 0) + len((t or "").split())
    sums = got.assign(k=got["doc_id"].astype(object).where(got["doc_id"].notna(), None)).groupby("k", dropna=False)["n_tokens"].sum()
    assert {(None if k != k else k): int(v) for k, v in sums.items()} == want
    assert got[got["doc_id"] == 2]["n_tokens"].tolist() != [] and got[got["doc_id"] == 2]["first_token"].max() == 8192
    empty = got[got["n_tokens"] == 0]
    assert len(empty) >= 3 and empty["bin"].isna().all()
    full = got[got["n_tokens"] > 0]
    for (_, _), g in full.groupby(["shard", "bin"]):
        g = g.sort_values("bin_offset")
        ends = (g["bin_offset"] + g["n_tokens"]).to_numpy()
        assert g["bin_offset"].iloc[0] == 0 and (g["bin_offset"].to_numpy()[1:] == ends[:-1]).all()
        assert ends[-1] <= g["bin_capacity"].iloc[0]
    assert packing.pack_documents(documents(rows).limit(0)).count() == 0
