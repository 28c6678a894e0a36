"""Cosine search against brute force."""

import numpy as np

from basketry.operators import vectors


def frame(spark, name, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)],
                                 f"{name} long, embedding array<double>")


def brute(q, v, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    sims = np.round(unit(q) @ unit(v).T, 6) + 0.0
    return {(i, int(j), p + 1) for i, row in enumerate(sims)
            for p, j in enumerate(sorted(range(len(row)), key=lambda j: (-row[j], j))[:k])}


def found(df):
    return {(r.query_id, r.vec_id, r.place) for r in df.collect()}


def test_topk_with_ties_zero_vectors_and_many_blocks(spark):
    rng = np.random.default_rng(7)
    v = rng.integers(-1, 2, (200, 4)).astype(float)  # many equal directions and some zero vectors
    q = np.vstack([rng.integers(-1, 2, (9, 4)).astype(float), np.zeros((1, 4))])
    stored, asked = frame(spark, "vec_id", v).repartition(6), frame(spark, "query_id", q)
    want = brute(q, v, 5)
    assert found(vectors.similarity_topk(asked, stored, 5)) == want
    assert found(vectors.similarity_topk(asked, stored, 5, query_bytes=64)) == want
    assert found(vectors.similarity_topk(asked, stored, 5, score_cells=30)) == want


def test_small_blocks_send_no_vector_twice_and_small_cells_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v, q = rng.integers(-1, 2, (300, 4)).astype(float), rng.integers(-1, 2, (40, 4)).astype(float)
    stored, asked = frame(spark, "vec_id", v).repartition(6), frame(spark, "query_id", q)
    sizes, whole = [], vectors.best_in_cells
    monkeypatch.setattr(vectors, "best_in_cells", lambda grid, *rest: sizes.append(grid.filter("kind = 1").count()) or whole(grid, *rest))
    want = brute(q, v, 5)
    assert found(vectors.similarity_topk(asked, stored, 5, query_bytes=64)) == want
    assert found(vectors.similarity_topk(asked, stored, 5, query_bytes=64, cell_bytes=256)) == want
    assert sizes == [300, 300 * 5]


def near_rows():
    """Unit vectors, copies of them scaled or moved by less and by more than rounding sees, zero vectors, and queries of
    which some have no copy."""
    rng = np.random.default_rng(9)
    base = np.abs(rng.normal(size=(40, 16)))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    moved = [base + d * rng.normal(size=base.shape) / 4 for d in (1e-4, 5e-4, 9e-4, 1e-3, 1.1e-3, 2e-3)]
    v = np.vstack([base, base * 3, *moved, np.zeros((3, 16))])
    return rng.permutation(v), np.vstack([base, rng.normal(size=(10, 16)), np.zeros((2, 16))])


def test_copies_answer_as_the_grid_does(spark):
    v, q = near_rows()
    stored, asked = frame(spark, "vec_id", v).repartition(3), frame(spark, "query_id", q)
    for k in (1, 3, 6):
        assert found(vectors.similarity_topk(asked, stored, k, copies_first=True)) == brute(q, v, k)


def test_queries_with_copies_need_no_grid(spark, monkeypatch):
    texts = [f"order {i} is late by {i % 7} days" for i in range(30)] + ["same words"] * 5 + [None, " "]
    tickets = spark.createDataFrame([(f"T{i}", "C", t, "Open", "x") for i, t in enumerate(texts)],
                                    "ticket_id string, customer_id string, issue_text string, status string, created_at string")
    documents = vectors.embed(vectors.tickets_to_documents(tickets))
    asked = documents.filter("trim(text) <> ''").select("text").distinct().selectExpr("xxhash64(text) AS query_id", "text")
    monkeypatch.setattr(vectors, "best_in_cells", None)
    best = vectors.search_tickets(asked, documents, 1).collect()
    assert len(best) == 31 and {r.similarity for r in best} == {1.0}
    assert [r.ticket_id for r in best if r.text == "same words"] == ["T30"]


def test_k_larger_than_the_table_and_no_queries(spark):
    v, q = np.eye(3), np.array([[1.0, 0.5, 0.0]])
    assert len(found(vectors.similarity_topk(frame(spark, "query_id", q), frame(spark, "vec_id", v), 10))) == 3
    none = frame(spark, "query_id", q).limit(0)
    assert vectors.similarity_topk(none, frame(spark, "vec_id", v), 3).count() == 0


def test_search_finds_the_same_words(spark):
    tickets = spark.createDataFrame(
        [("T1", "C1", "refund not received", "Open", "x"), ("T2", "C2", "app crashes on login", "Resolved", "x"),
         ("T3", "C3", None, "Open", "x")],
        "ticket_id string, customer_id string, issue_text string, status string, created_at string")
    documents = vectors.embed(vectors.tickets_to_documents(tickets))
    asked = spark.createDataFrame([(1, "Refund not RECEIVED")], "query_id long, text string")
    best = vectors.search_tickets(asked, documents, 2).orderBy("place").first()
    assert (best.ticket_id, best.similarity, best.status) == ("T1", 1.0, "Open")


def test_model_hook(spark):
    def lengths(texts):
        return texts.str.len().map(lambda n: [float(n), 0.0])

    df = spark.createDataFrame([("abc",), ("",)], "text string")
    assert [r.embedding for r in vectors.embed(df, model=lengths).collect()] == [[1.0, 0.0], [0.0, 0.0]]
