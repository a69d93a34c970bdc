from __future__ import annotations

import zlib

import numpy as np

from tracemill.llm import gru, toxicity

NICE = [f"word{i}" for i in range(120)]


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        w = [NICE[k] for k in rng.integers(0, len(NICE), int(rng.integers(5, 200)))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                w[int(rng.integers(0, len(w)))] = ["moron", "scum,", "Idiot"][int(rng.integers(0, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return rows, labels


def run(spark, docs, rows, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.score(docs(rows), table, fit_toxic=80, fit_other=160).collect()


def test_held_out_documents_are_told_apart(spark, docs):
    rows, labels = corpus(500)
    out = run(spark, docs, rows, labels)
    toxic = dict(labels)
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_every_window_counts(spark, docs):
    """One late window makes a very long text toxic."""
    rows, labels = corpus(400, 1)
    long_ = "word1 word2 " * 20_000
    out = {r["doc_id"]: r for r in run(spark, docs, rows + [(9001, long_), (9002, long_ + "moron scum idiot " + "word3 " * 40)], labels)}
    assert out[9002]["score"] > out[9001]["score"] and out[9002]["predicted"] == 1 and out[9001]["predicted"] == 0


def test_edge_rows(spark, docs):
    rows, labels = corpus(200, 2)
    extra = [(None, "moron"), (7001, None), (7002, ""), (7003, " \n"), (0, rows[0][1])]
    out = run(spark, docs, rows + extra, labels + [(None, 1), (5, None)])
    assert len(out) == len(rows) + 5
    assert len({r["score"] for r in out if r["doc_id"] in (7001, 7002, 7003)}) == 1
    assert len({r["score"] for r in out if r["doc_id"] == 0}) == 1
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert run(spark, docs, [], labels) == []
    assert {r["score"] for r in run(spark, docs, rows[:5], [])} == {0.0}
    assert {r["score"] for r in run(spark, docs, rows[:5], [(i, 1) for i in range(9)])} == {1.0}


def test_held_out_labels_change_nothing(spark, docs):
    rows, labels = corpus(150, 3)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    first, second = run(spark, docs, rows, labels), run(spark, docs, rows, flipped)
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_windows_cover_every_word():
    at, mask, text = toxicity.places(np.array([1, 32, 33, 100]))
    covered = set(at[mask].tolist())
    assert covered == set(range(166)) and text.tolist() == [0, 1, 2, 2, 3, 3, 3, 3, 3, 3]


def test_gradients():
    model = gru.Model({b"a": 1, b"b": 2}, np.zeros(3))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(0)
    places = rng.integers(0, 4, (6, 3))
    mask = np.ones((6, 3), bool)
    mask[4:, 1] = False
    y = np.array([1.0, 0, 1])
    x = model.embed(model.inputs([b"a", b"b", b"cde", b"xy"]))

    def loss(keep=False):
        gates = np.stack([x @ model.p["w"][k] + model.p["b"][k] for k in (0, 1)], 1)[places]
        if keep:
            return model.forward(gates, mask, keep=True)
        p = gru._sig(model.forward(gates, mask))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    logit, kept = loss(True)
    found, _ = model.backward((gru._sig(logit) - y) / 3, kept)
    for k, g in found.items():
        i = tuple(int(rng.integers(0, s)) for s in g.shape)
        old = model.p[k][i]
        model.p[k][i] = old + 1e-2
        up = loss()
        model.p[k][i] = old - 1e-2
        down = loss()
        model.p[k][i] = old
        assert abs((up - down) / 2e-2 - g[i]) < 2e-4 + 0.05 * abs(g[i]), k
