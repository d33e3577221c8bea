"""Personal data against plain regular expressions, and contexts that reveal unseen identifiers."""

import random
import re

from lexmill.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": kind == "card" and 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_seeds_match_plain_search(spark):
    r = random.Random(8)
    atoms = ["a", "b.c", "@", "x@y.z", "@d.e", "..", "_", "%", "+", "1.2.3.4", "999.1.1.1", "1.2.3", "4591718099287256", " ", "-",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (679) 555-1339", "+49", "12", "é", "\U0001f600", "\n", "(", ")", ".", "0"]
    texts = ["".join(r.choices(atoms, k=r.randint(1, 25))) for _ in range(600)]
    texts += [None, "", "a" * 100_000, "1" * 60_000, "1-" * 30_000, ("x@y.z 1.2.3.4 ") * 1500, "a.b_c@d.e_f@g.h"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(3, texts[3], "s")], "doc_id long, text string, spans string")
    got = {x.doc_id: [(s.kind, s.start, s.stop) for s in x.base] for x in pii.find_personal_data(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t), (i, t[:200])
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_contexts_reveal_unseen_identifiers(spark):
    texts = [f"Call tel: +1 555 0100{i} now" for i in range(6)]
    texts += ["Call tel: 0201-555-{}77 now".format(i) for i in range(3)]
    texts += ["order of 12345678 and of 4591718099287256", "the price of things of old"] + ["of of of of of"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.spans for x in pii.find_personal_data(df).collect()}
    for i in (6, 7, 8):
        assert [(s.kind, texts[i][s.start:s.stop]) for s in got[i]] == [("context", f"0201-555-{i - 6}77")]
    assert [s.kind for s in got[9]] == ["card"] and all(not got[i] for i in range(10, 16))
    row = df.where("doc_id = 6").withColumn("spans", pii.F.lit(None).cast(pii._LABELLED))
    text = spark.createDataFrame([(t, [tuple(s) for s in got[i]]) for i, t in enumerate(texts[:9])], f"text string, spans {pii._LABELLED}")
    clean = [x.c for x in text.select(pii.redact_personal_data("text", "spans").alias("c")).collect()]
    assert clean == ["Call tel: [phone] now"] * 6 + ["Call tel: [context] now"] * 3
    assert row.select(pii.redact_personal_data("text", "spans").alias("c")).first().c is not None


def revealed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {x.doc_id: [texts[x.doc_id][s.start:s.stop] for s in x.spans if s.kind == "context"] for x in pii.find_personal_data(df).collect()}


def test_context_word_with_a_digit(spark):
    texts = [f"Call tel2: +1 555 0100{i} now" for i in range(6)] + ["Call tel3: 0201-555-77 now", "at 9 tel4:\t0201-555-79", "row 12 0201-555-80"]
    got = revealed(spark, texts)
    assert got[6] == ["0201-555-77"] and got[7] == ["0201-555-79"] and got[8] == [] and not any(got[i] for i in range(6))


def test_lists_inherit_the_context(spark):
    texts = [f"Call tel: +1 555 0100{i} now" for i in range(6)]
    texts += ["tel: 0201-555-77 0201-555-78, 0201-555-79 and 0201-555-80", "tel: +1 555 01009, 0201-555-81", "tel: 12 0201-555-82", "x 0301-555-77 0301-555-78"]
    got = revealed(spark, texts)
    assert got[6] == ["0201-555-77", "0201-555-78", "0201-555-79"] and got[7] == ["0201-555-81"] and got[8] == got[9] == []


def test_a_list_holds_one_shape(spark):
    texts = [f"Call tel: +1 555 0100{i} now" for i in range(6)]
    texts += ["tel: 0201-555-77, 12345678 14.03.2024 10000 20000", "tel: (0201-555-78), 0301-444-79; paid 123456789", "tel: +1 555 01009, 555010099 here", "tel: 0201-555-70."]
    got = revealed(spark, texts)
    assert got[6] == ["0201-555-77"] and got[7] == ["0201-555-78", "0301-444-79"] and got[8] == [] and got[9] == ["0201-555-70"]


def test_words_before_are_those_of_the_text(spark):
    r = random.Random(4)
    texts = ["".join(r.choices(["a", "b1", " ", "  ", "7", "\n", "\u00e9", "9.9.9.9", "word" * 9], k=r.randint(1, 60))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (pii.CANDIDATE, pii.IP):
        for row in df.select("t", pii._with_words_before(pii.match_spans(pii.F.col("t"), pattern)).alias("s")).collect():
            for s in row.s:
                want, got = (re.search(pii.LAST_WORD, x[-64:]) for x in (row.t[:s.start], s.before))
                assert (want and want[1]) == (got and got[1]), (row.t, s)
