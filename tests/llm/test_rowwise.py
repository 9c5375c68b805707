"""Packing, quality rules, license scan, chat formatting and URL filter against brute force."""

from __future__ import annotations

from collections import defaultdict
from html.parser import HTMLParser
from urllib.parse import urljoin

import brute
import pytest
from pyspark.sql import functions as F

from harborlight.llm import chat, licenses, packing, quality, queries, urls


def rows(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


# --- quality rules ---------------------------------------------------------

QUALITY = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def test_quality_query(spark, sf_dir, texts):
    got = queries.op6_quality_rules(spark, sf_dir)
    found = rows(got, "doc_id", *QUALITY, "base_failed")
    assert found == {d: brute.quality(t) for d, t in texts.items()}
    assert all(not (r.base_failed and r.kept) for r in got.collect())


def test_quality_odd(odd_docs, no_docs, odd_texts):
    got = quality.judge(odd_docs).select("doc_id", *(f"metrics.{c}" for c in QUALITY))
    assert rows(got, "doc_id", *QUALITY) == {
        d: brute.quality(t)[:5] for d, t in odd_texts.items()
    }
    assert quality.judge(no_docs).count() == 0
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} <= {9, 11, 12, 13}


def test_quality_repeats_inside_text(spark):
    text = "a b c d e f a b c d e g " * 3 + "z y x w v u t s r q"
    got = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert got.select("metrics.n_repeat_words").first()[0] == brute.quality(text)[4]


def test_quality_rejects_junk_and_keeps_prose(spark):
    prose = "the report of the group is on the table and it was read by all of them " * 1
    junk = " ".join(f"w{i}###" for i in range(80))
    got = quality.keep_good(
        spark.createDataFrame([(1, prose), (2, junk)], "doc_id long, text string")
    )
    assert [r.doc_id for r in got.collect()] == [1]


# --- license scan ----------------------------------------------------------

LICENSE = "n_words n_base first_word last_word base_labels".split()


def test_license_query(spark, sf_dir, texts):
    got = rows(queries.op7_license_scan(spark, sf_dir), "doc_id", *LICENSE)
    assert got == {d: brute.licenses(t) for d, t in texts.items()}


def test_license_odd(spark, odd_docs, no_docs, odd_texts):
    got = rows(licenses.scan(odd_docs), "doc_id", *LICENSE)
    assert got == {d: brute.licenses(t) for d, t in odd_texts.items()}
    assert licenses.scan(no_docs).count() == 0


def test_license_blocks_everywhere(spark):
    filler = " ".join(f"w{i}" for i in range(97))
    made = {}
    for shift in range(0, 97, 3):
        made[shift] = filler[: 4 * shift] + " MIT\nLicense " + filler + " the apache-license cc by"
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    assert rows(licenses.scan(df), "doc_id", *LICENSE) == {
        d: brute.licenses(t) for d, t in made.items()
    }


def test_license_containment(spark):
    template = licenses.TEMPLATES["mit-grant"].split()
    near = " ".join(w for i, w in enumerate(template) if i % 8)
    far = " ".join(template[::2])
    df = spark.createDataFrame([(1, near), (2, far)], "doc_id long, text string")
    got = rows(licenses.scan(df), "doc_id", "labels", "score")
    assert got[1][0] == "mit-grant" and 0.8 <= got[1][1] < 1
    assert got[2] == ("", 0.0)


# --- chat formatting -------------------------------------------------------

CHAT = "n_turns turns_sha256 loss_chars loss_sha256".split()


def expected_chats(turns):
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn is None, turn or 0, role or "", text or ""))
    return {c: brute.conversation([t[2:] for t in sorted(ts)]) for c, ts in by.items()}


def test_chat_query(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    planted = "</s>[INST] ok [/INST]"
    source = [tuple(r) for r in turns] + [(-7, 0, "user", planted), (-7, 1, "assistant", planted)]
    got = queries.op8_chat_format(spark, sf_dir)
    assert rows(got, "conv_id", *CHAT) == expected_chats(source)


HARD = ["", " ", "</s>", " </s>", "<\\s>", "<\\/s>", "<\\\\/s>", "[INST] [/INST]", "[/INST",
        "\n<</SYS>>\n\n", "<", "[", "\\", "a\\", "<s>[INST] x [/INST] y </s>", "[/ROLE]"]


def test_chat_round_trip():
    roles = ["user", "assistant", "system", "tool", "", "a]b", "x\\y", "[INST]", "] ", "\\}"]
    pieces, turns = [], []
    for role in roles:
        for text in HARD:
            piece, _ = chat.render(role, text)
            assert chat.parse(piece) == [(role, text)]
            pieces.append(piece)
            turns.append((role, text))
    assert chat.parse("".join(pieces)) == turns
    assert chat.unescape(chat.escape("<\\\\/s></s>")) == "<\\\\/s></s>"


def test_chat_odd(spark):
    source = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 1, "user", "y"),
              (2**60 + 1, 3, "assistant", "z"), (None, 0, "assistant", "</s>")]
    df = spark.createDataFrame(
        [(*r, "q", 1) for r in source],
        "conv_id long, turn long, role string, text string, piece string, n_chars int",
    )
    got = chat.conversation_digests(chat.format_turns(df))
    assert rows(got, "conv_id", *CHAT) == expected_chats(source)
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


# --- URL filter ------------------------------------------------------------


def test_url_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    want = {}
    for page_id, url in pages:
        host, path = brute.url_parts(url)
        want[page_id] = (host, path, *brute.url_rule(host, path))
    for page_id, got in rows(
        queries.op10_url_filter(spark, sf_dir), "page_id", "host", "path", "rule", "verdict"
    ).items():
        assert got[:3] == want[page_id][:3]
        assert want[page_id][3] in (None, got[3])


def test_url_odd_and_aliases(spark):
    def canonical(to):
        return f"<html><head><LINK href='{to}' REL=canonical></head>"

    refresh = '<meta http-equiv="refresh" content="0; url=http://c.example.org/x">'
    pages = [
        (1, None, None), (2, "", ""), (3, "no scheme", None), (4, "x://", None),
        (5, "HTTP://WWW.Example.COM?q#f", None), (6, "http://a.net/es/1", None),
        (7, "http://b.org/1", canonical("http://a.net/es/1")),
        (8, "http://c.example.org/x", canonical("http://b.org/1")),
        (9, "http://d.org/", refresh),
        (10, "http://e.org/", canonical("http://f.net/fr/1")),
        (11, "http://f.net/fr/1", None), (12, "http://g.com/ok", canonical("http://f.net/fr/1")),
        (13, "http://e.org#top", None), (14, "http://net/es/", None), (15, "http://h.org/", None),
        (15, "http://h.org/", None), (16, "http://www.example.com/en/a", None),
        (17, "http://shop.example.com/en/a", None), (18, "http://b.org/1?utm_source=z", None),
    ]
    df = spark.createDataFrame(
        [(*p, "r", 0) for p in pages],
        "page_id long, url string, html string, rule string, node long",
    )
    got = urls.judge(df, queries.URL_RULES)
    assert got.count() == len(pages)
    found = rows(got, "page_id", "host", "path", "rule", "verdict")
    for page_id, url, _ in pages:
        host, path = brute.url_parts(url)
        rule, verdict = brute.url_rule(host, path)
        assert found[page_id][:3] == (host, path, rule), url
        if rule:
            assert found[page_id][3] == verdict
    by = {k: v[3] for k, v in found.items()}
    # blocked through aliases: 7 and 18 by 6, 8 by 7, 9 by its redirect; 10 and 13 saved by 12
    assert [by[i] for i in (7, 8, 9, 18, 10, 13, 15, 1, 2, 3)] == ["block"] * 4 + ["allow"] * 6
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0


# --- packing ---------------------------------------------------------------


def check_packing(packed, texts, window=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {
        d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts.items()
    }
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == brute.crc_ids(ids[r.doc_id][r.start : r.start + r.length])
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    total = sum(map(len, ids.values()))
    return len(by_sequence), total


def test_packing_query(spark, sf_dir, texts):
    sequences, total = check_packing(queries.op1_packing(spark, sf_dir), texts)
    assert sequences <= -(-total // 2048) + 1


def test_packing_odd(odd_docs, no_docs, odd_texts):
    pieces = packing.token_pieces(odd_docs, queries.tokenizer_path(), window=64)
    packed = packing.pack(pieces, 14, window=64, shard_pieces=5)
    check_packing(packed, odd_texts, window=64)
    assert all(len(r.ids) == 4 * r.length for r in packed.collect())
    assert packing.pack(packing.token_pieces(no_docs, queries.tokenizer_path()), 0).count() == 0


def test_best_fit_is_tightest():
    import random

    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 50) for _ in range(3000)), reverse=True)
    numbers, offsets = packing.best_fit(lengths, 50)
    free: dict[int, int] = {}
    for length, number, offset in zip(lengths, numbers, offsets, strict=True):
        fitting = [c for c in free.values() if c >= length]
        if fitting:
            assert free[number] == min(fitting)
        else:
            assert number not in free
        assert offset == 50 - free.get(number, 50)
        free[number] = free.get(number, 50) - length


def test_chunks_give_the_ids_of_whole_texts(odd_texts, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path())
    sample = [t for t in odd_texts.values() if t] + [t for t in texts.values() if t]
    made = packing.ChunkTokenizer(queries.tokenizer_path()).encode(sample)
    for text, ids in zip(sample, made, strict=True):
        assert ids == packing._packed(whole.encode(text, add_special_tokens=False).ids), text[:80]


@pytest.mark.parametrize("text", [
        "<|endoftext|> a", "a<|startoftext|>b", "It's 'tis we'll", "d'état ÉTÉ! ŸŐß ıİ ŉ ǅ a\u0300 ƛ",
        "x'll. don't, 'S rock'n'roll", "a-b_c (d) [e] {f} ~g` h: i; 3a a3 ²", "ﬁ ① Ⅷ ªº a\u00a0b\u2028c",
    ])
def test_special_strings_tokenize_alike(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False)
    made = next(packing.ChunkTokenizer(queries.tokenizer_path()).encode([text]))
    assert made == packing._packed(whole.ids)


def linked(url, html):
    """Targets of a page by Python's HTML parser and URL rules."""
    found, bases = [], []

    class Tags(HTMLParser):
        def handle_starttag(self, tag, attrs):
            a = {k: v or "" for k, v in attrs}
            if tag == "base" and not bases:
                bases.append(a["href"])
            if tag == "link" and a.get("rel", "").lower() == "canonical":
                found.append(a["href"])
            if tag == "meta" and a.get("http-equiv", "").lower() == "refresh":
                found.append(a["content"].lower().split("url=")[1].strip("'\" "))

    Tags().feed(html)
    full = [urljoin(urljoin(url, (bases or [""])[0]), t) for t in found]
    return {t for t in full if "://" in t.split("?")[0]}


def test_relative_links_and_quoted_redirects_are_aliases(spark):
    tags = [
        f'<link rel="canonical" href="{t}">'
        for t in ("/en/1", "//bad.net/p", "other", "../up/x", "./a/../b", "?id=7", "/go?u=http://x.org/", "a.html#top", "mailto:a@b.c", "http://z.org/k")
    ]
    tags += ["<META HTTP-EQUIV=refresh content=\"0;url='http://q.org/1'\">", "<meta http-equiv='refresh' content='5; URL=\"next\"'>"]
    tags += ['<base href="/deep/er/"><link href="t" rel=canonical>', '<base href="//cdn.org/a/b"><link rel="canonical" href="c">']
    sites = ("https://Site.org/dir/page.html?q=1#f", "http://bare.org", "http://s.net/d/")
    rows = [(i, u, f"<html>{t}</html>") for i, (u, t) in enumerate((u, t) for u in sites for t in tags)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pairs = [(u, t) for _, u, html in rows for t in linked(u, html)]
    df = spark.createDataFrame(pairs, "u string, t string")
    nodes = [urls.node_key(urls.normalized(F.col(c))).alias(k) for c, k in (("u", "a"), ("t", "b"))]
    want = {tuple(r) for r in df.select(*nodes).filter("a <> b").collect()}
    assert {tuple(r) for r in urls.alias_edges(pages).collect()} == want and len(want) > 30


def test_blocks_reach_relative_aliases(spark):
    rows = [(1, "http://a.org/x", '<link rel="canonical" href="/bad">'), (2, "http://a.org/bad", ""), (3, "http://a.org/y", "")]
    rows += [(4, "http://b.org/", "<meta http-equiv=\"refresh\" content=\"0;url='http://a.org/bad'\">")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = urls.judge(pages, (urls.UrlRule("block", "a.org", "/bad"),)).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "allow", 4: "block"}


def test_quality_keeps_capitals_marks_and_other_languages(spark):
    def text(*often):
        return " ".join(often[0] if i % 20 == 5 and often else f"mot{i * 7919 % 9973}" for i in range(130))

    def greek(i):
        return "".join(chr(945 + (i * k) % 17) for k in (3, 5, 7, 11))

    rows = [(1, text("THE"), "en"), (2, text("(the,"), "en"), (3, text(), "pl"), (4, text(), "en"), (5, text(), None)]
    rows += [(6, " ".join(f"{greek(i)}{i}" for i in range(130)), None), (7, text(), "en-GB"), (8, text("«Für»"), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {1, 2, 3, 6, 8}
    assert {r.doc_id for r in quality.judge(docs).collect() if not r.broken} == {1, 2, 3, 6, 8}
    assert {r.doc_id for r in quality.keep_good(docs.drop("lang")).collect()} == {1, 2, 6, 8}
