import pytest

from qloom.llm import decontamination as q
from tests.llm import frames

ITEM = "If Maria buys 12 apples for 30 cents each and gives 5 of the apples to her brother Tom, how many apples does Maria keep and what did the kept apples cost?"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, key string, id int" if rows and len(rows[0]) > 2 else "item_id long, text string")


def found(docs, items, **settings):
    return {(r["doc_id"], r["item_id"]) for r in q.contaminated(docs, items, **settings).collect()}


def test_canonical_words():
    assert q.canonical("(Paris,")[0] == q.NAME and q.canonical("PARIS")[0] == "paris" and q.canonical("Paris", False) == ("paris", "")
    assert [q.canonical(w)[0] for w in ("12", "3.5%", "$1,000", "5km", "twelve", "1st")] == [q.NUMBER] * 6
    assert q.canonical("km.")[0] == q.UNIT and q.canonical("--") == ("--", "") and q.canonical("...") == ("", "")


def test_exact_lowered_and_reparameterised_copies(spark):
    other = ITEM.replace("Maria", "Lena").replace("Tom", "Karl").replace("12", "48").replace("30", "7").replace("5 of", "9 of")
    docs = frames.documents(spark, [(1, f"Some words before it. {ITEM} And after."), (2, f"x {ITEM.lower()} y"), (3, f"Intro\n{other}\nend"), (4, "An unrelated text about Maria and 12 apples for the brother.")])
    assert found(docs, bench(spark, [(7, ITEM)])) == {(1, 7), (2, 7), (3, 7)}
    rows = {r["doc_id"]: r for r in q.contaminated(docs, bench(spark, [(7, ITEM)])).collect()}
    assert rows[1]["n_changed"] == 0 and rows[3]["n_changed"] == 5 and rows[3]["n_windows"] >= 0.9 * rows[3]["item_windows"]


def test_inconsistent_slots_are_no_copy(spark):
    # Maria occurs three times and can't become three persons
    text = ITEM.replace("does Maria keep", "does Lena keep").replace("If Maria", "If Karl")
    long = frames.documents(spark, [(1, text)])
    assert found(long, bench(spark, [(7, ITEM)]), coverage=0.9) == set()


def test_many_copies_in_one_document(spark):
    docs = frames.documents(spark, [(1, " filler words here ".join([ITEM] * 50))])
    rows = q.contaminated(docs, bench(spark, [(7, ITEM)])).collect()
    assert len(rows) == 1 and rows[0]["n_windows"] == rows[0]["item_windows"]


def test_short_items_and_ties(spark):
    items = bench(spark, [(1, "where does the river end"), (1, "where does the river end"), (2, "where does the river end"), (3, "12 Paris 30"), (4, None), (5, ""), (None, ITEM)])
    docs = frames.documents(spark, [(1, "tell me where does the river end today"), (1, "tell me where does the river end today"), (2, "12 Paris 30"), (3, ITEM), (None, ITEM)])
    want = {(1, 1), (1, 2), (3, None), (None, None)}
    assert found(docs, items) == want
    assert found(docs, items, broadcast_windows=0) == want


def test_odd_rows(spark):
    docs = frames.odd(spark)
    items = bench(spark, [(9, "alpha beta gamma delta epsilon zeta eta theta", "x", 1), (10, "Lorem dolor sit amet consectetur. Lorem dolor sit amet", "y", 2)])
    assert found(docs, items) == {(1, 9), (6, 10), (7, 10)}
    kept = q.filter_documents(docs, items)
    assert kept.schema == docs.schema
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, _ in frames.ODD if i not in (1, 6, 7)), key=str)


def test_empty_tables(spark):
    items = bench(spark, [(9, ITEM)])
    assert q.contaminated(frames.nothing(spark), items).count() == 0
    docs = frames.documents(spark, [(1, ITEM)])
    none = items.where("false")
    assert q.contaminated(docs, none).count() == 0 and q.filter_documents(docs, none).count() == 1


@pytest.mark.parametrize("bound", [q.BROADCAST_WINDOWS, 0])
def test_query_finds_the_passages(spark, sf_dir, bound):
    from qloom.sources.tables import scan

    flat = lambda t: " ".join(t.lower().split())
    docs, items = scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark")
    want = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if flat(i["text"]) in flat(d["text"])}
    assert want and found(docs, items, broadcast_windows=bound) == want


def test_items_without_literal_windows_are_searched_as_they_are(spark):
    items = bench(spark, [(1, "What is 17 + 23?"), (2, "太郎は林檎を三つ持っています。"), (3, "Anna Berta Carla Dora Emil"), (4, "17 + 23"), (5, "十二")])
    docs = frames.documents(
        spark,
        [
            (1, "A test. what is 17 + 23 and then"),
            (2, "What is 18 + 23? What is 17 - 25?"),
            (3, "昔々、太郎は林檎を三つ持っています。それから"),
            (4, "昔々、太郎は林檎を四つ持っています。"),
            (5, "with anna, berta, carla, dora (emil) there"),
            (6, "Anna Berta Dora Carla Emil; 17 + 23 and 十二"),
        ],
    )
    for broadcast in (10, 0):
        assert found(docs, items, broadcast_windows=broadcast) == {(1, 1), (3, 2), (5, 3)}


def test_windows_equal_the_polynomial_of_their_tokens():
    import numpy as np

    reader = q.Reader(8, 4)
    token = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    sums, base, wrap = reader.sums(token), int(q._BASE), (1 << 64) - 1
    for length in (1, 5, 8, 299, 300):
        for at, got in enumerate(reader.windows(sums, length).view(np.uint64).tolist()):
            value = 0
            for t in token[at : at + length].tolist():
                value = (value * base + t) & wrap
            assert got == ((value ^ value >> 29) * base + length) & wrap
    assert len(reader.windows(sums, 301)) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_with_slots_equal_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    literal = [f"w{chr(97 + k)}x" for k in range(20)]

    def words(n):
        return [rng.choice([rng.choice(literal)] * 4 + [str(rng.randrange(9)), rng.choice(["Ada", "Bob", "Cyd"]), "km"]) for _ in range(n)]

    items = [(k, words(rng.randrange(9, 14))) for k in range(12)]

    def changed(item):
        """Other numbers, the same for equal ones, or another for each."""
        same = {str(d): str(rng.randrange(100, 900)) for d in range(9)}
        free = rng.random() < 0.4
        return [(str(rng.randrange(100, 900)) if free else same[w]) if w.isdigit() else w for w in item]

    docs = [(d, words(rng.randrange(5)) + (changed(rng.choice(items)[1]) if d % 2 else []) + words(rng.randrange(5))) for d in range(60)]

    def windows(text, names):
        out = []
        for p in range(len(text) - 7):
            part = [q.canonical(w, names) for w in text[p : p + 8]]
            if sum(t not in (q.NUMBER, q.NAME, q.UNIT) for t, _ in part) >= 4:
                out.append((p, tuple(t for t, _ in part), [(t, v) for t, v in part if v]))
        return out

    want = set()
    for i, item in items:
        mine = {n: windows(item, n) for n in (True, False)}
        places = {p for n in mine for p, _, _ in mine[n]}
        for d, text in docs:
            held = set()
            diagonals = {}
            for n in mine:
                for p, shape, slots in windows(text, n):
                    for at, other, were in mine[n]:
                        if shape == other:
                            starts, pairs = diagonals.setdefault(p - at, (set(), set()))
                            starts.add(at)
                            pairs.update(zip(were, slots))
            for starts, pairs in diagonals.values():
                if len({w for w, _ in pairs}) == len(pairs):
                    held |= starts
            if places and len(held) >= 0.5 * len(places):
                want.add((d, i))
    got = found(frames.documents(spark, [(d, " ".join(t)) for d, t in docs]), bench(spark, [(i, " ".join(t)) for i, t in items]))
    assert got == want and len(want) > 10
