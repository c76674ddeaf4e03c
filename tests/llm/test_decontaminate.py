import random
import re

from rowloom.llm.decontaminate import decontaminate, drop_contaminated

DOCS = "doc_id long, text string, key string, words string"
ITEMS = "item_id long, text string, n string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    w, hit, ids = words(text), set(), set()
    for item_id, item_text in items:
        v = words(item_text)
        n = min(len(v), 10)
        for j in range(len(v) - n + 1) if v else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[j : j + n]:
                    hit |= set(range(i, i + n))
                    ids |= {str(item_id)} if item_id is not None else set()
    return len(w), len(hit), sorted(ids), bool(hit)


def check(spark, docs, items):
    df = spark.createDataFrame([(i, t, "x", None) for i, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    found = decontaminate(df, bench).collect()
    expected = [(i, *brute(t, items)) for i, t in docs]
    rows = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    kept = drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        (i, t) for i, t in docs if not brute(t, items)[3]
    ) if all(i is not None and t is not None for i, t in docs) else True


def test_random_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "É", "éa", "x1", "The"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    docs = [(i, text(rng.randrange(0, 80))) for i in range(40)]
    for i in range(20):  # passages, whole and cut
        _, t = rng.choice(items)
        w = t.split()
        docs.append((100 + i, text(5) + " " + " ".join(w[rng.randrange(3) :]).upper() + " " + text(7)))
    check(spark, docs, items)


def test_edges(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (1, "short item"), (None, "no id here")]
    items += [(2, None), (3, "  ..  "), (4, "no " * 30)]
    docs = [(1, None), (1, ""), (None, "a short item, SHORT ITEM"), (2, "no id here"), (3, "no " * 3000), (3, "no " * 3000)]
    docs += [(4, "zero one two three four five six seven eight nine ten twelve"), (5, "one two three four five")]
    check(spark, docs, items)
    check(spark, docs, [])
    check(spark, [], items)
