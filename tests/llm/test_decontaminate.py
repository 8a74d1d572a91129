import random

import pytest

from webloom.llm import decontaminate as D

ITEMS = [(7, "If Bob has 9 apples and gives Eve 4 apples then he has how many apples left"),
         (8, "the big old dog ran away"), (9, None), (10, "few words"),
         (11, "A train covers 120 km in 2 hours, so what is its speed in the last 30 minutes of the trip")]
ITEM = "item_id long, text string"


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, ITEM)


def found(docs_of, items, rows):
    return sorted((r["doc_id"], r["item_id"]) for r in D.leaks(docs_of(rows), items).collect())


def test_reparameterised_and_verbatim(docs_of, items):
    rows = [
        (1, "Well, if Tom has 5 apples and gives Anna 2 apples then he has how many apples left today"),
        (2, "x y z. THE BIG OLD DOG ran, away! and more"),
        (3, "a train covers 300 miles in 4 hours, so what is its speed in the last 10 minutes of the trip"),
        (4, None), (5, ""), (6, "few words"), (7, "the big old dog ran"),
        (8, "some other text about apples and trains and hours of a trip that has nothing to do with it"),
    ]
    assert found(docs_of, items, rows) == [(1, 7), (2, 8), (3, 11), (6, 10)]


def test_inconsistent_slots_do_not_match(docs_of, spark):
    item = spark.createDataFrame([(1, "take 3 red balls and then add 3 more balls to the box")], ITEM)
    rows = [(1, "take 5 red balls and then add 5 more balls to the box"),
            (2, "take 5 red balls and then add 6 more"),
            (3, "take 5 red balls and then add 6 more balls to the box")]
    got = {r["doc_id"]: r["n_literal_windows"] for r in D.leaks(docs_of(rows), item).collect()}
    assert set(got) == {1} and got[1] == 0


def test_conflict_across_windows(docs_of, spark):
    text = "first we put {} coins on the big wooden table near the door and later we take {} coins from it again"
    item = spark.createDataFrame([(1, text.format(4, 4))], ITEM)
    assert found(docs_of, item, [(1, text.format(9, 9)), (2, text.format(9, 8))]) == [(1, 1), (2, 1)]
    got = {r["doc_id"]: (r["n_windows"], r["n_literal_windows"]) for r in
           D.leaks(docs_of([(1, text.format(9, 9)), (2, text.format(9, 8))]), item).collect()}
    assert got[1][0] > got[1][1] and got[2][0] == got[2][1]  # a contradicting run counts by literal windows only


def test_matches_brute_force_on_literal_texts(docs_of, spark):
    r = random.Random(4)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    texts = [" ".join(r.choices(words, k=r.randint(5, 14))) for _ in range(30)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 40)) + (texts[i % 30].split()[:r.randint(4, 14)] if i % 3 else []))) for i in range(120)]
    want = set()
    for i, t in rows:
        w = t.split()
        for j, x in enumerate(texts):
            b = x.split()
            k = min(len(b), D.K)
            if any(w[p:p + k] == b[q:q + k] for p in range(len(w) - k + 1) for q in range(len(b) - k + 1)):
                want.add((i, j))
    got = set(found(docs_of, spark.createDataFrame(list(enumerate(texts)), ITEM), rows))
    assert {i for i, _ in got} == {i for i, _ in want} and got <= want


def test_empty_tables_and_repeats(docs_of, items, spark):
    assert found(docs_of, items, []) == []
    assert found(docs_of, spark.createDataFrame([], ITEM), [(1, "a b c d e f g h")]) == []
    twice = spark.createDataFrame([(5, "the big old dog ran away"), (4, "the big old dog ran away"), (None, "x")], ITEM)
    assert found(docs_of, twice, [(1, "the big old dog ran away"), (1, "the big old dog ran away")]) == [(1, 4)]
    got = D.leaks(docs_of([(None, "the big old dog ran away")]), twice).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(None, 4)]


def test_every_item_of_a_template_is_found(docs_of, spark):
    text = "first we put {} coins on the big wooden table near the door and later we take {} coins from it again"
    table = spark.createDataFrame([(i, text.format(i, i + 50)) for i in range(1, 7)], ITEM)
    rows = [(i, "well then " + text.format(i, i + 50)) for i in range(1, 7)] + [(100, text.format(77, 78))]
    assert found(docs_of, table, rows) == sorted((d, i) for d, _ in rows for i in range(1, 7))


def test_slots_are_compared_with_their_own_item(docs_of, spark):
    # no 8 tokens without a number: a contradicting run leaves nothing
    text = "we take {} red balls out of it then add {} more balls to the old box"
    table = spark.createDataFrame([(1, text.format(7, 7)), (2, text.format(5, 6))], ITEM)
    rows = [(1, text.format(8, 8)), (2, text.format(5, 6)), (3, text.format(7, 7))]
    got = set(found(docs_of, table, rows))
    assert (2, 2) in got and (1, 1) in got and (3, 1) in got and (2, 1) not in got


def test_matches_brute_force_item_by_item(docs_of, spark):
    r = random.Random(5)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    common = r.choices(words, k=10)
    texts = [" ".join(r.choices(words, k=r.randint(2, 9)) + (common if j % 2 else [])) + f" end{j}" for j in range(24)]
    texts = [t for t in texts if len(t.split()) >= D.K]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 30)) + texts[i % len(texts)].split()[:r.randint(4, 20)])) for i in range(80)]
    grams = lambda t: {tuple(t.split()[p:p + D.K]) for p in range(len(t.split()) - D.K + 1)}
    want = sorted((i, j) for i, t in rows for j, x in enumerate(texts) if grams(t) & grams(x))
    assert found(docs_of, spark.createDataFrame(list(enumerate(texts)), ITEM), rows) == want


@pytest.mark.parametrize("item, copy", [
    ("12 plus 13 is 25 and 14 plus 15 is 29", "so: 12 plus 13 is 25 and 14 plus 15 is 29, right"),  # too few literal words
    ("3 km, 4 km, 5 km, 6 km, 7 km", "3 km, 4 km, 5 km, 6 km, 7 km"),
    ("1 2 3 4 5", "count 1 2 3 4 5 now"),  # short, no literal word at all
    ("we saw Anna Berta Carla Dora Emma Frieda and Greta", "we saw Anna Berta Carla Dora Emma Frieda and Greta"),
    ("Der Hund und die Katze", "er sagt Der Hund und die Katze"),  # title case in mid-sentence
    ("yesterday old Bob ate all the red apples", "yesterday old bob ate all the red apples"),  # lower-cased name
])
def test_verbatim_copies_need_no_literal_words(docs_of, spark, item, copy):
    table = spark.createDataFrame([(1, item), (2, "an item of which no word is in any text here at all")], ITEM)
    other = " ".join(f"x{w}" for w in copy.split())
    assert found(docs_of, table, [(1, copy), (2, other), (3, "8 plus 9 is 17 and 5 plus 6 is 11")]) == [(1, 1)]


def test_short_items_match_whole_sentences_and_lines(docs_of, spark):
    item = spark.createDataFrame([(1, "What is 2+2?"), (2, "Why"), (3, "name the capital")], ITEM)
    rows = [(1, "What is 2+2?"), (2, "so I ask: what is 2+2 ? four"), (3, "he knows what is 2+2 and more"), (4, "a line\n  WHAT IS 2+2\nnext"),
            (5, "Why? because"), (6, "this is why it is"), (7, "name the capital of x"), (8, "Well. Name the capital!"), (9, "what is 2+3")]
    assert found(docs_of, item, rows) == [(1, 1), (2, 1), (4, 1), (5, 2), (8, 3)]


def test_values_map_one_to_one_both_ways(docs_of, spark):
    text = "first we put {} coins on the big wooden table near the door and later we take {} coins from it again"
    item = spark.createDataFrame([(1, text.format(3, 4))], ITEM)
    got = {r["doc_id"]: (r["n_windows"], r["n_literal_windows"]) for r in
           D.leaks(docs_of([(1, text.format(8, 9)), (2, text.format(5, 5))]), item).collect()}
    assert got[1][0] > got[1][1] and got[2][0] == got[2][1]
    short = "take {} red balls and then add {} more balls to the box"
    item = spark.createDataFrame([(1, short.format(3, 4))], ITEM)
    assert found(docs_of, item, [(1, short.format(7, 8)), (2, short.format(5, 5))]) == [(1, 1)]


def test_alignment_equals_brute_force():
    import numpy as np
    r = np.random.default_rng(3)
    k, side = 5, D.K - 1
    for _ in range(200):
        at = r.integers(-1, 3, (1, k + 2 * side))
        bt = np.where(r.random(at.shape) < 0.85, at, r.integers(-1, 3, at.shape))
        at[:, side:side + k] = bt[:, side:side + k] = r.integers(0, 3, (1, k))
        a = r.integers(1, 4, at.shape)
        b = np.where((at == 0) & (r.random(at.shape) < 0.9), a, r.integers(1, 4, at.shape))
        b[:, side:side + k] = np.where(at[:, side:side + k] == 0, a[:, side:side + k], b[:, side:side + k])

        def agrees(j, a=a, b=b, at=at, bt=bt):
            return at[0, j] == bt[0, j] >= 0 and (at[0, j] > 0 or a[0, j] == b[0, j])
        lo, hi = side, side + k
        while lo > 0 and agrees(lo - 1):
            lo -= 1
        while hi < a.shape[1] and agrees(hi):
            hi += 1
        want = [(int(a[0, j]), int(b[0, j])) for j in range(lo, hi) if at[0, j] > 0]
        assert D.aligned_pairs(k, a, at, b, bt) == [want]


def python_steps(node):
    """Python steps of the tasks that ``node`` belongs to, and the most in any stage below."""
    name, kids = node.nodeName(), node.children()
    if name == "AdaptiveSparkPlan":
        return python_steps(node.inputPlan())
    below = [python_steps(kids.apply(i)) for i in range(kids.size())]
    here, most = sum(x for x, _ in below) + (name == "MapInArrow"), max([m for _, m in below], default=0)
    return (0 if "Exchange" in name else here), max(most, here)


def test_a_task_has_one_python_step(docs_of, items, monkeypatch):
    cut, most = D.cut_lineage, []
    monkeypatch.setattr(D, "cut_lineage", lambda df: (most.append(python_steps(df._jdf.queryExecution().executedPlan())[1]), cut(df))[1])
    assert found(docs_of, items, [(1, "x y z. THE BIG OLD DOG ran, away! and more"), (2, "other")]) == [(1, 8)]
    assert max(most) == 1


def test_windows_do_not_depend_on_other_texts_of_the_chunk(monkeypatch):
    import pyarrow as pa
    r = random.Random(6)
    words = ["5", "km", "days", "hours", "Bob", "apples", "trip", "speed", "12", "long."]
    texts = [" ".join(r.choices(words, k=r.randint(0, 30))) for _ in range(80)]

    def rows(part, first=0):
        batch = pa.record_batch({"id": pa.array(range(first, first + len(part))), "text": pa.array(part)})
        out = [x for b in D._window_rows([batch], (1, 2, D.K)) for x in b.to_pylist()]
        for x in out:  # values outside the text (type -1) are never read
            x["around"] = x["around"] and [v for v, t in zip(x["around"], x["types"], strict=True) if t >= 0]
        return sorted(map(str, out))
    alone = sorted(x for i, t in enumerate(texts) for x in rows([t], i))
    assert rows(texts) == alone
    monkeypatch.setattr(D, "CHUNK", 200)
    assert rows(texts) == alone
