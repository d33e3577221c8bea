"""Benchmark matches against plain search."""

import hashlib
import random
import re

from lexmill.llm.decontaminate import Item, SuffixAutomaton, decontaminate, find_contamination, items_digest, normalised_words


def plain(words, items, window=13):
    """Hit word numbers and items by comparing every window everywhere."""
    hit, found = set(), set()
    for key, w in items:
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            for i in range(len(words) - k + 1):
                if words[i:i + k] == w[j:j + k]:
                    hit |= set(range(i, i + k))
                    found.add(key)
    return hit, found


def test_words():
    text = "AB-c1_ÄÖ é\x00Z\x7fq ①x"
    assert [w.decode() for w in normalised_words(text)] == re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    assert normalised_words(None) == normalised_words("") == []


def test_automaton_against_plain_search():
    r = random.Random(4)
    for seed in range(60):
        alphabet = [bytes([97 + i]) for i in range(r.choice([2, 3, 6]))]
        window = r.choice([1, 2, 4, 13])
        items = [(str(i), r.choices(alphabet, k=r.choice([1, 2, 3, 5, 9, 20, 30]))) for i in range(r.randint(1, 6))]
        doc = r.choices([*alphabet, b"z"], k=120)
        if r.random() < 0.7:
            at = r.randrange(100)
            doc[at:at] = r.choice(items)[1]
        runs, found = SuffixAutomaton([Item(k, tuple(w)) for k, w in items], window).hits(doc)
        hit, want = plain(doc, items, window)
        assert {x for a, b in runs for x in range(a, b)} == hit, seed
        assert {items[i][0] for i in found} == want
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_documents_blocks_and_odd_rows(spark, words):
    items = [(1, " ".join(words(1, 30))), (2, " ".join(words(2, 8))), (10, " ".join(words(2, 8))), (3, ""), (4, None),
             (None, " ".join(words(5, 20))), (1, " ".join(words(1, 30)))]
    def join(*parts):
        return " ".join(parts)
    texts = [join(*words(9, 50)), join(*words(9, 50), *words(1, 30)[5:20], *words(8, 60)), join("X;", *words(2, 8), "end"),
             None, "", "...", join(*words(5, 20)), join(*words(2, 8), *words(10, 152)), join(*words(2, 8), *words(10, 153)),
             join(*[w.upper() + "," for w in words(1, 30)])]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)] + [(2, texts[2], "q")], "doc_id long, text string, c string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 40):
        got = {x.doc_id: x for x in find_contamination(docs, bench, block_words=block).collect()}
        for i, t in enumerate(texts):
            hit, found = plain(normalised_words(t), [(str(k), normalised_words(x)) for k, x in items if x])
            listed = sorted(k for k in found if k != "None")
            c = got[i].contamination
            assert (c.n_words, c.n_hit, c.n_items, c["items"]) == (len(normalised_words(t)), len(hit), len(listed), listed), (block, i)
            assert c.contaminated == (len(hit) > 0 and 20 * len(hit) >= c.n_words)
    assert [got[7].contamination.contaminated, got[8].contamination.contaminated] == [True, False]
    digest = find_contamination(docs, bench).select("doc_id", items_digest("contamination.items").alias("d")).where("doc_id = 2").first().d
    assert digest == hashlib.sha256(b"10,2").hexdigest()
    kept = decontaminate(docs, bench, max_run=5)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [0, 3, 4, 5, 8]
    assert kept.where("doc_id = 8").first().text.split() == words(10, 153)
    assert decontaminate(docs, bench).where("doc_id = 8").first().text == texts[8]
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_contamination(docs, bench.limit(0)).where("contamination.n_hit > 0").count() == 0


def test_very_long_document_and_dotted_names(spark, words):
    item = words(1, 30)
    body = words(9, 60_000)
    long = " ".join([*body[:59_000], *item, *body[59_000:]])
    rows = [(1, long, 1, 2), (2, long + " " + " ".join(item * 200), 1, 2), (None, " ".join(item), 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, a int")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {x.doc_id: x.contamination for x in find_contamination(docs, bench).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].contaminated) == (60_030, 30, False)
    assert (found[2].n_hit, found[2].contaminated) == (6030, True) and found[None].contaminated
    kept = decontaminate(docs, bench, max_run=10)
    assert kept.columns == docs.columns
    assert [(x.doc_id, len(x.text.split())) for x in kept.collect()] == [(1, 60_000)]
