"""Personal data against the base patterns in Python, and bootstrapping on planted contexts."""

from __future__ import annotations

import random

import brute
import pytest

from harborlight.llm import personal, queries


def base_text(text):
    found = brute.personal(text)
    return ",".join(f"{k}:{a}:{b}" for k in personal.KINDS for a, b in found[k])


def counts(text):
    return tuple(len(brute.personal(text)[k]) for k in personal.KINDS)


def check(df, texts):
    for r in df.collect():
        text = texts[r.doc_id]
        assert r.base == base_text(text), text
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts(text)
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_query(spark, sf_dir, texts):
    got = queries.op3_pii(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.base_sha256 == brute.sha(base_text(texts[r.doc_id]))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts(texts[r.doc_id])


HARD = [
    "a@b.c@d.e x@y.zfoo%bar@q.r @a.b a@b a@b. a@-.- é@é.com ü.a@b-c.d.. %@%.%",
    "1.2.3.4.5 256.1.1.1 1.1.1.256 0001.0255.000.0 1.2.3 1..2.3.4 99999999999.1.1.1 1.2.3.4.5.6.7.8",
    "4111111111111111 4111-1111 1111 1111 4111  1111 1111 1111 4111111111111112 0000000000000000",
    "12345678901234567890 1-2-3 4111 1111 1111 1111 4111111111111111-",
    "+1 (523) 555-1055 +12 +1.2 ++123456789 +1234567890123456 +1 (((( +9 8 7 6 5 4 3 2)",
    "\U0001f600 a@b.cc \U0001f600 1.1.1.1 é +44 20 7946 0958x 4111111111111111",
    "1" * 3000 + "." + "2." * 3000 + "x", "a" * 3000 + "@" + "b." * 3000, "+" * 500 + "1" * 30,
]


def test_hard_texts(spark, odd_docs, odd_texts, no_docs):
    texts = dict(enumerate(HARD))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(personal.personal_data(df), texts)
    check(personal.personal_data(odd_docs), odd_texts)
    assert personal.personal_data(no_docs).count() == 0


def test_random_texts(spark):
    rng = random.Random(11)
    texts = {d: "".join(rng.choices("1203 -.+@a%()é\n", k=rng.randrange(300))) for d in range(200)}
    texts |= {1000 + d: "".join(rng.choices("41 -+.@a", weights=[9, 9, 2, 2, 1, 3, 1, 1], k=200)) for d in range(200)}
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in texts.items()], "doc_id long, text string, kind string, start int")
    check(personal.personal_data(df), texts)


def test_bootstrapping_finds_unseen_identifiers(spark):
    """Account names after "write to" are not e-mail addresses by pattern, but by context."""
    texts = {i: f"please write to user{i}@mail.example.com for help" for i in range(8)}
    texts |= {20: "please write to user20(at)mail for help", 21: "there were 20 of them for help"}
    texts |= {22: None, 23: "please write to user7@mail.example.com for help"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in personal.personal_data(df).collect()}
    assert got[20].spans == "email:16:30" and got[20].n_found == 1 and got[20].n_email == 0
    assert got[21].spans == "" and got[22].spans == ""
    assert all(got[i].spans == got[i].base != "" for i in range(8))


def test_redaction(spark):
    rows = [(1, "to a@b.c, 1.2.3.4é 4111111111111111 end", 7), (2, "nothing", 8), (None, None, 9), (2, "x a@b.c", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind long")
    got = personal.redact(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "to [EMAIL], [IP]é [CARD] end", 7), (2, "nothing", 8), (None, None, 9), (2, "x [EMAIL]", 0)], key=str
    )
    assert personal.redact(df.limit(0)).count() == 0


@pytest.mark.parametrize("digits, valid", [("4111111111111111", True), ("4111111111111112", False)])
def test_luhn(spark, digits, valid):
    df = spark.createDataFrame([(digits,)], "d string")
    assert df.select(personal.luhn(df["d"])).first()[0] is valid


def found_spans(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: (r.spans, r.n_found) for r in personal.personal_data(df).collect()}


def test_spans_of_several_tokens_are_seeds_and_found(spark):
    texts = {i: f"please call +1 (017) 555-77{10 + i} for help" for i in range(8)}
    texts |= {20: "please call (0171) 555 7713, for help", 21: "there were 20 30 40 of them for help"}
    texts |= {100 + i: f"paid by card {c} on monday" for i, c in enumerate(CARDS)} | {120: "paid by card 4000 12 x34 on monday"}
    texts |= {200 + i: f"kindly mail to <user{i}@mail.example.com>, or wait" for i in range(6)}
    texts |= {220: "kindly mail to me20(at)mail, or wait"}
    got = found_spans(spark, texts)
    assert got[20] == ("phone:13:27", 1) and got[21] == ("", 0)
    assert got[120] == ("card:13:24", 1) and got[220] == ("email:15:27", 1)
    assert all(n == 0 and spans for d, (spans, n) in got.items() if d not in (20, 21, 120, 220))


CARDS = ["4111 1111 1111 1111", "5555 5555 5555 4444", "4012 8888 8888 1881", "5105 1051 0510 5100", "4222-2222-2222-2220"]


def test_context_goes_past_numbers_and_long_words(spark):
    url = "https:" + "/long" * 30
    texts = {i: f"line no. {i} user{i}@mail.example.com" for i in range(8)} | {20: "line no. 7: me20(at)mail"}
    texts |= {100 + i: f"see {url} person{i}@mail.example.com next" for i in range(8)} | {120: f"see {url} my20(at)mail next"}
    texts |= {200 + i: f"who{i}@mail.example.com wrote this" for i in range(8)} | {220: "we20(at)mail wrote this"}
    got = found_spans(spark, texts)
    assert got[20] == ("email:12:24", 1)
    assert got[120] == (f"email:{len(url) + 5}:{len(url) + 17}", 1)
    assert got[220] == ("email:0:12", 1)
    assert all(n == 0 and spans for d, (spans, n) in got.items() if d not in (20, 120, 220))


def test_secrets_are_told_by_context(spark):
    """Long runs of letters and digits count only where trusted patterns surround them."""
    rng = random.Random(3)
    key = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(12)]
    texts = {i: f'and then token = "{key[i]}" was set' for i in range(8)}
    texts |= {20: 'and then token = "x7-short" was set', 21: f"digest {key[8]} of file", 22: f"sum {key[9]} here"}
    got = found_spans(spark, texts)
    assert all(got[i] == (f"secret:{18}:{58}", 1) for i in range(8))
    assert got[20] == ("secret:18:26", 1) and got[21] == got[22] == ("", 0)


def brute_bootstrap(runs, spans):
    """Plain graph scores: (instance, kind) → score of what trusted patterns support."""
    import math
    import re

    edges = {(i, p) for i, ps in runs for p in ps} | {(i, p) for i, _, ps in spans for p in ps}
    first = {(i, k) for i, k, _ in spans}
    seeds = {i for i, _ in first}
    prior = {i for i, _ in runs if re.match(personal.SECRET_FORM, i) and i not in seeds}
    known = {e: 1.0 for e in first} | {(i, "secret"): 1.0 for i in prior}
    size, found = None, {}
    while True:
        trusted = {}
        for p in {p for _, p in edges}:
            inside = {i for i, q in edges if q == p}
            for kind in personal.ALL_KINDS:
                scores = [s for (i, k), s in known.items() if k == kind and i in inside]
                if len(scores) >= personal.LEAST_INSTANCES and sum(scores) / len(inside) >= personal.LEAST_SHARE:
                    trusted[p, kind] = sum(scores) / len(inside)
        found = {}
        for i in {i for i, _ in edges} - seeds:
            scores = {}
            for kind in personal.ALL_KINDS:
                trusts = [t for (p, k), t in trusted.items() if k == kind and (i, p) in edges]
                if trusts:
                    scores[kind] = 1 - math.exp(sum(math.log(max(1 - t, 1e-6)) for t in trusts))
            if scores:
                score, kind = max((s, k) for k, s in scores.items())
                found[i] = (kind, score)
        if (len(trusted), len(found)) == size:
            return found
        size = (len(trusted), len(found))
        known = {e: 1.0 for e in first}
        for i in prior | set(found):
            options = ([(1.0, "secret")] if i in prior else []) + ([found[i][::-1]] if i in found else [])
            score, kind = max(options)
            known[i, kind] = score


def test_graph_scores(spark):
    """Random graphs with several kinds, assumed seeds and chains over several rounds."""
    rng = random.Random(8)
    names = [f"i{n}" for n in range(60)] + ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(12)]
    patterns = [f"p{n}" for n in range(14)]
    runs = [(rng.choice(names), rng.sample(patterns[:10], 2)) for _ in range(70)]
    spans = [(rng.choice(names[:30]), rng.choice(["email", "phone"]), rng.sample(patterns[4:], 2)) for _ in range(50)]
    # a chain: known instances trust one pattern, its instances the next
    spans += [(f"c{n}", "card", ["q0", "q1"]) for n in range(9)]
    runs += [(f"d{n}", ["q0", "q2"]) for n in range(3)] + [(f"c{n}", ["q2", "q2"]) for n in range(5)] + [("e0", ["q2", "q3"])]
    runs += [(f"k{n}", ["q4", "q4"]) for n in range(2)] + [(names[60 + n], ["q4", "q4"]) for n in range(7)]
    got = personal.bootstrap(
        spark.createDataFrame(runs, "instance string, patterns array<string>"),
        spark.createDataFrame(spans, "instance string, kind string, patterns array<string>"),
    ).collect()
    want = brute_bootstrap(runs, spans)
    assert {r.instance: r.kind for r in got} == {i: k for i, (k, _) in want.items()}
    assert all(abs(r.score - want[r.instance][1]) < 1e-9 for r in got)
    assert {"d0", "e0", "k0"} <= set(want) and len({k for k, _ in want.values()}) > 1


def test_given_documents_hold_more_than_base_spans(spark):
    """What is found in the given documents is what stands behind ``token =``."""
    import re

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    right = wrong = 0
    for r in personal.personal_data(docs).filter("n_found > 0").collect():
        for span in set(r.spans.split(",")) - set(r.base.split(",")):
            _, start, stop = span.split(":")
            before = texts[r.doc_id][: int(start)]
            if re.search(r'token = "$', before, re.I) and re.fullmatch("[0-9a-fA-F]{40}", texts[r.doc_id][int(start) : int(stop)]):
                right += 1
            else:
                wrong += 1
    there = sum(len(re.findall(r'token = "[0-9a-f]{40}"', t or "", re.I)) for t in texts.values())
    assert right > 0 and right >= 0.95 * (right + wrong) and right >= 0.9 * there, (right, wrong, there)
