"""Piece counts against a plain greedy matcher and a public word-piece tokenizer."""

import random

from lexmill.llm.token_counts import DEFAULT_VOCABULARY, WORDS, LongestMatchAutomaton, Vocabulary, token_counts


def greedy(word, vocabulary):
    n, at = 0, 0
    while at < len(word):
        end = len(word)
        while word[at:end] not in (vocabulary.final if end == len(word) else vocabulary.inner):
            end -= 1
        at, n = end, n + 1
    return n


def test_random_vocabularies():
    r = random.Random(1)
    for seed in range(30):
        pieces = {bytes(r.choices(b"ab", k=r.randint(1, 6))) for _ in range(r.randint(1, 25))}
        v = Vocabulary(set(r.sample(sorted(pieces), len(pieces) // 2)), set(r.sample(sorted(pieces), len(pieces) // 2)))
        a = LongestMatchAutomaton(v)
        for _ in range(60):
            w = bytes(r.choices(b"abc", k=r.randint(0, 30)))
            assert a.count(w) == greedy(w, v), (seed, w)


def test_against_wordpiece_library():
    from tokenizers import Tokenizer
    from tokenizers.models import WordPiece

    r = random.Random(2)
    inner = {"".join(r.choices("abcd", k=r.randint(2, 5))) for _ in range(60)}
    vocab = {p: i for i, p in enumerate(sorted({"[UNK]", *"abcd", *["##" + c for c in "abcd"], *inner, *["##" + p for p in inner]}))}
    t = Tokenizer(WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=1000))
    raw = {p.encode() for p in inner} | {c.encode() for c in "abcd"}
    a = LongestMatchAutomaton(Vocabulary(raw, raw))
    for _ in range(200):
        w = "".join(r.choices("abcd", k=r.randint(1, 40)))
        assert a.count(w.encode()) == len(t.encode(w).tokens)


def test_documents_with_public_vocabulary(spark):
    v = Vocabulary.from_file(DEFAULT_VOCABULARY)
    texts = ["The quick brown fox, isn't 42!", "", None, "Ñandú ÉCOLE 漢字 \U0001f600", "a" * 50_000, "the the the", "x_y  z\n\t"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {x.doc_id: tuple(x.n) for x in df.select("doc_id", token_counts("text", v).alias("n")).collect()}
    for i, t in enumerate(texts):
        w = WORDS.findall((t or "").lower())
        if len(t or "") < 1000:
            assert got[i] == (len(w), sum(greedy(x.encode(), v) for x in w), len(t or ""))
    assert got[4][0] == 1 and got[5][1] == 3
    assert df.limit(0).select(token_counts("text", v).alias("n")).count() == 0
