"""Quality measures and line frequency against plain Python."""

import random
import re

import pytest

from lexmill.llm.quality_rules import Limits, keep_good, quality_verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    where = {}
    for i in range(len(w) - 7):
        where.setdefault(tuple(w[i:i + 8]), []).append(i)
    hit = {j for p in where.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def plain_kept(rows, limits):
    """Verdicts by counting, per host, the distinct texts that hold a line."""
    holders, hosts = {}, {}
    for _, host, text in rows:
        hosts.setdefault(host, set()).add(text or "")
        for x in (text or "").split("\n"):
            if WORD.search(x):
                holders.setdefault((host, normal(x)), set()).add(text or "")
    out = []
    for _, host, text in rows:
        n, *_, failed = plain(text)
        gone = sum(
            len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x)
            and len(holders[host, normal(x)]) >= limits.line_documents
            and (100 * len(holders[host, normal(x)]) > limits.line_share[0] * len(hosts[host])
                 or len(holders[host, normal(x)]) >= (limits.line_documents_enough or len(rows) + 1)))
        out.append((gone, not failed and not (gone > 0 and (2 * gone > n or n - gone < 20))))
    return out


def corpus(words):
    r = random.Random(6)
    rows = []
    for i in range(120):
        body = [" ".join(words(i * 9 + j, r.randint(1, 14))) for j in range(r.randint(1, 8))]
        if i % 4 == 0:
            body.insert(r.randrange(len(body) + 1), "Share  THIS page with\tyour friends and read on" if i % 8 else "share this page with your friends and read on")
        if i % 11 == 0:
            body += body[-1:] * 5
        if i % 13 == 0:
            body = [" ".join(words(3, 9)) + " # $"] * 6
        rows.append((i, r.choice(["a", "b", None]), "\n".join(body)))
    rows += [(500, "a", None), (501, "a", ""), (502, "b", " \n\r\x0b"), (None, "b", " ".join(words(7, 60))), (503, "c", " ".join(words(1, 5000)))]
    rows += [rows[4], rows[4], (504, rows[8][1], rows[8][2])]
    return rows


@pytest.mark.parametrize("limits", [
    Limits(), Limits(line_documents=5, line_share=(4, 100)), Limits(line_documents=5, line_share=(90, 100), line_documents_enough=12)])
def test_verdicts_match_plain_counts(spark, words, limits):
    rows = corpus(words)
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, source string, text string, kept string").repartition(3)
    got = {(x.doc_id, x.n_words, x.word_chars): x for x in quality_verdicts(df, limits=limits).collect()}
    assert quality_verdicts(df, limits=limits).count() == len(rows)
    for (key, _, text), (gone, kept) in zip(rows, plain_kept(rows, limits)):
        x = got[(key, *plain(text)[:2])]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == plain(text), key
        assert (x.n_removed, x.kept) == (gone, kept), key


def test_keep_good_keeps_columns_rows_and_removes_lines(spark, words):
    limits = Limits(line_documents=5, line_share=(4, 100))
    rows = corpus(words)
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, source string, text string, kept string")
    want = sorted((x[0] is None, x[0] or 0) for x, (_, kept) in zip(rows, plain_kept(rows, limits)) if kept)
    for option in (False, True):
        out = keep_good(df, limits=limits, remove_lines=option)
        assert out.columns == df.columns
        found = out.collect()
        assert sorted((x.doc_id is None, x.doc_id or 0) for x in found) == want
        if option:
            assert not any("this page with" in normal(x.text) for x in found if x.source == "a")
        else:
            texts = {x[0]: x[2] for x in rows}
            assert all(texts[x.doc_id] == x.text for x in found)
    assert keep_good(df.limit(0)).count() == 0 and quality_verdicts(df.limit(0)).count() == 0
