"""The mix in whole documents where quotas are smaller than documents."""

from collections import Counter

from jobloom.llm import mixing


def test_long_documents_keep_their_share(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    # 20 sources: a hot one of long documents, one of about a document per shard, 18 others.
    size = {"a_hot": (300, 600), "s01_rare": (200, 270)} | {f"s{i:02}": (17, 1000) for i in range(18)}
    rows = [(s, n) for s, (n, k) in size.items() for _ in range(k)]
    df = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(rows)],
                               "doc_id long, text string, source string")
    order = sorted(size)
    goal = dict(zip(order, mixing.targets([size[s][0] * size[s][1] for s in order],
                                          [1 + i % 3 for i in range(len(order))])))
    kept = Counter()
    for r in mixing.mixed_documents(df).collect():
        kept[r.source] += size[r.source][0]
    for s in ("a_hot", "s01_rare"):
        assert goal[s] < size[s][0] * size[s][1] / 2
        assert 0.6 * goal[s] < kept[s] < 1.4 * goal[s], (s, kept[s], goal[s])


def test_a_source_at_three_times_loses_no_words_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [("a", 1)] * 40 + [("b", 2)] * 30 + [("z", 25)] * 4000
    df = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(rows)],
                               "doc_id long, text string, source string")
    kept = Counter()
    for r in mixing.mix_sources(df).collect():
        assert r.taken <= 3 * r.size
        kept[rows[r.doc_id][0]] += r.taken
    assert kept["a"] == 120 and kept["b"] == 180
