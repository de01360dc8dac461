"""The operators against brute force, on whole small tables."""

from __future__ import annotations

import hashlib
import math
import os
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickvault.llm import bpe, chat, fingerprint, html, idfile, jaccard, lm, packing, quality, substring, tokens
from tickvault.llm.graph import components
from tickvault.llm.queries import QUERIES, SQL


def split(text):
    return (text or "").encode().split()


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.tokenizer_path())


@pytest.fixture(scope="module")
def ids(library, rows):
    return {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, none, name):
    assert QUERIES[name](spark, none).count() == (1 if name == "op7_chat" else 0)


def test_empty_pipeline(spark, none):
    assert corpus_pipeline.run(spark, none).count() == 0


def test_quality_rules(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet/*.parquet'")
    cur = con.execute(SQL["op4_quality_rules"])
    names = [c[0] for c in cur.description]
    got = QUERIES["op4_quality_rules"](spark, sf)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())
    led = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    assert {"lang", "source", "failure_bits"} <= set(led.columns) and len(set(led.columns)) == len(led.columns)
    ab = {r.rule: (r.failed, r.only_this) for r in quality.ablation(led, "v1").collect()}
    bits = [r.failure_bits for r in led.collect()]
    assert ab == {n: (sum(b & m != 0 for b in bits), sum(b == m for b in bits)) for n, m in quality.BIT.items()}


def test_quality_odd_rows(odd):
    assert quality.ledger(odd).count() == 7


def shingles(text, n, lower=False):
    w = split(text)
    w = [x.lower() for x in w] if lower else w
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_fingerprints(spark, sf, rows):
    got = {r.doc_id: r for r in QUERIES["op1_fingerprint"](spark, sf).collect()}
    assert len(got) == len(rows)
    by_text, off = defaultdict(set), []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == sha(edited.encode())
        by_text[t].add(r.fingerprint)
        for other, near in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = shingles(t, 5), shingles(other, 5)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert 0 <= near <= 1 and abs(near - true) <= (1e-9 if max(len(a), len(b)) <= fingerprint.FLOOR else 0.2)
            off.append(abs(near - true))
    assert sum(off) / len(off) <= 0.03 and sum(x > 0.1 for x in off) <= 0.05 * len(off)
    assert all(len(f) == 1 for f in by_text.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables")
def test_fingerprints_of_driver_documents(spark):
    """Five hundredths on average, in a size that does not follow that of long texts."""
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op1_fingerprint"](spark, "/root/testdata/sf0.001").collect()}
    off = []
    for k, (i, t) in enumerate(docs):
        cut = len(t) // 4
        a, b = shingles(t, 5), shingles(t[: len(t) - cut] + docs[(k + 1) % len(docs)][1][:cut], 5)
        off.append(abs(got[i].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
        assert len(got[i].fingerprint) <= 9 + 8 * max(fingerprint.FLOOR, len(a) / 32)
    assert sum(off) / len(off) <= 0.05


def test_fingerprints_shuffle_texts_once(spark, sf):
    """The window takes the partitions that with_next() made; the sketches between them do not hide those."""
    plan = QUERIES["op1_fingerprint"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan and "Window" in plan


def test_sketch_keeps_partitions_and_columns(spark):
    """Columns named like those of the steps, in any case, stay, and so does the partitioning."""
    names = ["_w", "__H", "_full", "a.b", "row", "sketch"]
    docs = spark.createDataFrame([(i, "a b c d e f", *["mine"] * len(names)) for i in range(9)], ["doc_id", "text", *names]).repartition(3, "doc_id")
    got = fingerprint.with_sketch(docs, "text", "sketch")
    assert got.columns == ["doc_id", "text", *names] and got.where("`_w` <> 'mine' or `__H` <> 'mine' or `a.b` <> 'mine' or size(sketch.hashes) <> 2").isEmpty()
    assert got.groupBy("doc_id").agg(F.max("sketch"))._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_next_of_many_rows_of_one_id(spark):
    """Null and repeated ids are spread over ranges and keep their order."""
    rows = [(None, f"n{k}") for k in range(300)] + [(5, f"t{k}") for k in range(300)] + [(7, "x"), (7, "x")]
    got = fingerprint.with_next(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).where("guest = 0")
    assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == sorted(((i or 0), t) for i, t in rows)
    assert got.groupBy("range").count().agg(F.max("count")).first()[0] < 200


def test_fingerprints_of_odd_rows(spark, odd):
    assert fingerprint.with_next(odd).where("guest = 0").count() == 7
    one = odd.where("doc_id = 2")
    assert fingerprint.with_next(one).where("guest = 0").count() == 1


def test_sketches_merge_and_contain(spark):
    text = [" ".join(f"x{i}" for i in range(k, k + n)) for k, n in ((0, 60000), (500, 18000), (59000, 12000))]
    df = spark.createDataFrame([tuple(text)], "a string, b string, c string")
    for c in "abc":
        df = fingerprint.with_sketch(df, c, f"s{c}")
    r = df.select(fingerprint.containment(F.col("sb"), F.col("sa")).alias("inside"), fingerprint.containment(F.col("sa"), F.col("sb")).alias("part"), fingerprint.likeness(fingerprint.merged(F.col("sa"), F.col("sb")), F.col("sa")).alias("same")).first()
    assert r.inside == 1.0 and abs(r.part - 0.3) < 0.08 and r.same == 1.0


def test_substring_dedup(spark, sf, rows):
    seen, want = set(), {}
    for i, t in rows:
        w = split(t)
        gone = [0] * len(w)
        for k in range(len(w) - 19):
            x = tuple(w[k : k + 20])
            if x in seen:
                gone[k : k + 20] = [1] * 20
            seen.add(x)
        want[i] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, sf).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 1000


def test_substring_dedup_of_odd_rows(odd):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed) for r in substring.deduplicated(odd, carry=True).collect())
    assert got == [(False, 0, 0, 0), (False, 0, 26, 0), (True, 2, 27, 26), (True, 4, 2, 0), (True, 4, 26, 26), (True, 4, 26, 26), (True, 9, 0, 0)]


def test_bpe(spark, sf, rows, ids):
    got = {r.doc_id: r for r in QUERIES["op3_bpe_trie"](spark, sf).collect()}
    for i, t in rows:
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids[i]), sha(np.array(ids[i], "<u4").tobytes()), sha((t or "").encode()))


def test_bpe_of_any_text(library):
    import random

    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "é", "1", "²", "'s", "'", "!", "_", "ª", "×", "ɏ", "<|endoftext|>", "漢", "😀", "́", "٣", "the", " the", "​", "\x00"]
    some = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(1500)] + ["=" * 9000, " " * 5000, "ab" * 3000]
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    trie = bpe.codec()
    assert list(trie.encode(some)) == want
    assert [trie.decode(x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]
    assert [np.frombuffer(b, "<u4").tolist() for b in tokens.encoder().encode(some)] == want


def test_html():
    page = "<html><head><title>no</title></head><body><nav><a>menu</a></nav><article><h1>Head</h1><p>One &amp; two,\n three<br>four.<p>Next &#233; one &lt;x&gt;<ul><li>i<li>j</ul><div class='comments'><p>Nice post, thanks!</p></div><form><p>Sign up</p></form><script>var x='<p>no</p>'</script></article><aside>side</aside><footer>&copy; foot</footer>"
    assert html.main_blocks(page) == ["Head", "One & two, three four.", "Next é one <x>", "i", "j"]
    plain = "<body><div id=sidebar><p>Links, more links, and so on, here.</p></div><div class=content><h2>T</h2><p>Some long text, with commas, and more. Yes.</p><p>Second one, again, long enough.</p></div><div class=ad>Buy, now!</div></body>"
    assert html.main_blocks(plain) == ["T", "Some long text, with commas, and more. Yes.", "Second one, again, long enough."]
    assert html.main_blocks("") == [] and html.main_blocks("just text") == ["just text"] and html.main_blocks("<p>cut &am") == ["cut &am"]


def test_html_keeps_all_content():
    def text(k):
        return f"Part {k} of the text, with commas, and some more. Yes, it is long enough."

    def ps(a, b):
        return "".join(f"<p>{text(k)}</p>" for k in range(a, b))

    def want(n):
        return [text(k) for k in range(n)]

    assert html.main_blocks(f"<body><div class=story><h1>T</h1><div class=text>{ps(0, 19)}</div><div class=more>{ps(19, 20)}</div></div></body>") == ["T", *want(20)]
    assert html.main_blocks(f"<body><h1>T</h1><div>{text(0)}</div><p>x</p></body>")[:2] == ["T", text(0)]
    assert html.main_blocks(f"<body><main><section>{ps(0, 4)}</section><article>{ps(4, 10)}</article></main></body>") == want(10)
    assert html.main_blocks(f"<body><article>{ps(0, 6)}</article><article>{ps(6, 10)}</article></body>") == want(10)
    listed = html.main_blocks(f"<body><p>{text(0)}<ul><li>i<li>j</ul><blockquote>q</blockquote><table><tr><td>c</table><p>{text(1)}</body>")
    assert listed == [text(0), "i", "j", "q", "c", text(1)]
    assert html.main_blocks(f"<body><main><p>by me</p><article><h1>T</h1>{ps(0, 3)}<p>End.</article></main><footer>foot</footer></body>") == ["T", *want(3), "End."]


def test_html_wrappers_are_not_furniture():
    text = [f"Part {k} of the text, with commas, and some more. Yes, it is long enough." for k in range(6)]
    ps = "".join(f"<p>{t}</p>" for t in text)
    side = "<div class=sidebar><p>Links, more links, and so on, here, for all of you.</p></div>"
    for wrapper in ("<div id=page class='with-sidebar'>", "<div class='no-comments'>", "<section id=has-banner>", "<form action='/page.aspx'>"):
        end = "</" + wrapper[1:].split()[0] + ">"
        assert html.main_blocks(f"<body>{wrapper}<article>{ps}</article>{side}{end}</body>") == text
        assert html.main_blocks(f"<body>{wrapper}<main>{ps}</main>{side}{end}</body>") == text
        assert html.main_blocks(f"<body>{wrapper}{side}<div class=text>{ps}</div>{end}<p>x</p></body>") == text
    comments = "<div class=comments><article class=comment><p>Nice post, with commas, and more. Thanks, it is long enough.</p></article></div>"
    assert html.main_blocks(f"<body><article>{ps}</article>{comments}<form><p>{text[0]}</p></form></body>") == text
    assert html.main_blocks(f"<body><div class=with-sidebar><article>{ps}</article>{comments}</div></body>") == text
    assert html.main_blocks(f"<body><div hidden><article>{ps}</article></div><nav><article>{ps}</article></nav></body>") == []


def brute_ratios(blocks):
    """Fused ratios of (whole tag path, text), by the definition."""
    def marks(t):
        return sum(unicodedata.category(c).startswith("P") for c in t)

    own = []
    for path, _ in blocks:
        same = [t for p, t in blocks if p == path]
        own.append(sum(map(len, same)) / len(same) * (1 + math.log(1 + sum(map(marks, same)) / len(same))))
    n = len(own)
    return [math.sqrt(own[k] * (own[max(k - 1, 0)] + 2 * own[k] + own[min(k + 1, n - 1)]) / 4) for k in range(n)]


def test_html_ratios_of_whole_paths():
    import random

    rng = random.Random(2)
    for _ in range(30):
        page = html.Blocks()
        page.feed("".join(rng.choice(["<div>", "<p>", "</p>", "</div>", "<ul><li>", "</ul>", "<h2>", "</h2>", "<section>"]) + "x. y, z! "[: rng.randrange(9)] * rng.randrange(4) for _ in range(60)))
        page.close()

        def path(e):
            return () if e < 0 else (*path(page.parent[e]), page.tag[e])

        got = html.fused_ratios([page.path[e] if e >= 0 else -1 for e, _ in page.blocks], [t for _, t in page.blocks])
        assert got == pytest.approx(brute_ratios([(path(e), t) for e, t in page.blocks]))


def planted_page(rng, k):
    """A page without telling tags, and its article: long paragraphs, short ones, lists and quotes among links and teasers."""
    def some(a, b):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) + rng.choice(["", "", "", ",", "."]) for _ in range(rng.randint(a, b)))

    wanted = ["Head " + some(3, 6)]
    body = f"<h1>{wanted[0]}</h1>"
    for kind in ["p", "p class=notice", *rng.choices(["p", "p", "ul", "blockquote"], k=rng.randint(3, 8)), "p"]:
        text = some(40, 90) if kind.startswith("p") else some(3, 30)
        wanted.append(text)
        body += f"<ul><li>{text}</ul>" if kind == "ul" else f"<{kind}>{text}</{kind.split()[0]}>"
    links = "".join(f"<li><a href=x>{some(1, 3)}</a>" for _ in range(rng.randint(4, 12)))
    tag = ("article", "div class=story", "section id=c1")[k % 3]
    teasers = "".join(f"<div class=box><div><span>{some(2, 5)}</span></div></div>" for _ in range(rng.randint(0, 6)))
    return f"<body><div class=hd><ul>{links}</ul></div><{tag}>{body}</{tag.split()[0]}><div>{teasers}</div><footer><p>{some(20, 40)}</footer>", wanted


def test_html_of_planted_pages():
    import random

    rng, hit, found, all_of = random.Random(6), 0, 0, 0
    for k in range(150):
        page, wanted = planted_page(rng, k)
        got = html.main_blocks(page)
        hit += len({*got} & {*wanted})
        found += len(got)
        all_of += len(wanted)
    assert hit >= 0.99 * all_of and hit >= 0.99 * found


def test_html_threshold_decides():
    import random

    rng = random.Random(7)
    pages = [planted_page(rng, k)[0] for k in range(60)]
    kept = [sum(len(html.main_blocks(p, t)) for p in pages) for t in (0.0, 0.02, html.THRESHOLD, 0.99)]
    assert kept[0] > kept[1] > kept[2] > kept[3]


def test_html_names_inside_an_article():
    long = "Some long text, with commas, and more of it. Yes, it goes on and on, as texts do."
    page = f"<body><nav><p>{long}</nav><article><h1>T</h1><p>{long} 1</p><p class=notice>{long} 2</p><div class=legal-analysis><p>{long} 3</p></div><div class=ad><p>{long} 4</p></div><div class='comments'><p>{long} 5</p></div></article>"
    assert html.main_blocks(page) == ["T", f"{long} 1", f"{long} 2", f"{long} 3"]


def test_html_of_deep_and_long_pages():
    """Time in proportion to the page, also for elements that are never closed."""
    import time

    def took(page):
        began = time.process_time()
        html.main_blocks(page)
        return time.process_time() - began

    assert took("<div>x y z" * 8000) < 2
    for part in ("<div>x y z", "<center><form>x y z", "<ul><li>x</p></section>", "<p>Some text, and more.</p></foo></article>"):
        assert took(part * 16000) < 40 * took(part * 800) + 0.5


def test_html_query(spark, tmp_path):
    spark.createDataFrame([(1, "u", None), (2, None, "<p>x"), (2, None, "<p>x"), (None, "v", "")], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(((r.page_id or 0), r.text, r.n_chars) for r in QUERIES["op5_html"](spark, str(tmp_path)).collect()) == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]


def packing_holds(pieces, ids):
    """Each id in one piece, and sequences without gaps or overlaps; gives the share of the sequences that is filled."""
    per, seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        full = ids[r.doc_id] + [packing.END_ID]
        part = full[r.start : r.start + r.length]
        assert len(part) == r.length > 0 and r.doc_tokens == len(full) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        per[r.doc_id].append((r.start, r.length))
        seq[r.sequence_id].append((r.offset, r.length))
    assert set(per) == set(ids)
    for i, p in per.items():
        assert [s for s, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1]] and sum(n for _, n in p) == len(ids[i]) + 1
    for p in seq.values():
        assert [s for s, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1]] and sum(n for _, n in p) <= packing.SEQUENCE
    return sum(r.length for r in pieces) / (len(seq) * packing.SEQUENCE)


def test_packing(spark, sf, ids):
    assert packing_holds(QUERIES["op6_packing"](spark, sf).collect(), ids) > 0.9


def test_packing_of_a_histogram():
    import random

    rng = random.Random(5)
    hist = Counter(rng.choices([3, 700, 1024, 1025, 2048, 5, 1], k=50_000)) | Counter(rng.randrange(1, 2049) for _ in range(50_000))
    found = packing.patterns(hist)
    assert Counter({n: c for n, c in hist.items()}) == sum((Counter({n: c * k for n, k in Counter(p).items()}) for c, p in found), Counter())
    assert all(sum(p) <= 2048 for _, p in found)


def test_repeated_rows_are_packed_apart(odd):
    got = packing.packed(packing.pieces(odd)).collect()
    assert len(got) == 7 and len({(r.sequence_id, r.offset) for r in got}) == 7


def test_chat(spark, tmp_path):
    rows = [(-7, 0, "user", "of the table"), (None, 3, "user", "lost too"), (1, 1, "assistant", "second \\ <|endoftext|> é 漢"), (1, 0, "user", "first\n"), (2, 0, "system", None), (2, 1, "assistant", ""), (2, 2, "assistant", " \n lead"), (None, 0, "assistant", "lost"), (3, 0, None, "x"), (3, 0, "user", "tie"), (3, 0, "user", "tie")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(SQL["op7_chat"])
    names = [c[0] for c in cur.description]
    assert sorted(map(str, map(tuple, QUERIES["op7_chat"](spark, str(tmp_path)).select(*names).collect()))) == sorted(map(str, cur.fetchall()))
    text, spans = chat.render([("user", "a"), ("assistant", "b\\"), ("assistant", "<|endoftext|>")])
    assert chat.mask([(0, 2), (2, 5), (5, 5), (5, 7), (7, 9)], [(1, 3), (6, 7)]) == [True, True, False, True, False]
    assert chat.mask([(0, 1)], []) == [] + [False] and chat.mask([], [(0, 1)]) == []
    assert chat.parse(text) == [("user", "a"), ("assistant", "b\\"), ("assistant", "<|endoftext|>")] and [chat.unescape(text[a:b]) for a, b in spans] == ["b\\", "<|endoftext|>"]


def brute_lm(toks, train):
    """score of each document by the definition, without a filter."""
    c = Counter(w for i in train for w in toks[i])
    pairs = Counter(p for i in train for p in zip(toks[i], toks[i][1:]))
    n, v = sum(c.values()), len(c)
    worth = {p: max(0, math.ceil(2 ** (math.floor(2 * math.log2(k) + 1e-9) / 2) - 1e-9) - lm.DISCOUNT) for p, k in pairs.items()}
    sums = Counter()
    for (first, _), x in worth.items():
        sums[first] += x

    def p(before, w):
        single = (c[w] + 1) / (n + v + 1)
        return worth.get((before, w), 0) / c[before] + (1 - sums[before] / c[before]) * single if before is not None and c[before] else single

    return c, n, v, p


def test_lm(spark, sf, rows):
    toks = {i: [w.lower() for w in split(t)] + [b" "] for i, t in rows}
    train = [i for i in toks if zlib.crc32(str(i).encode()) % 7 != 2]
    c, n, v, p = brute_lm(toks, train)
    for before in [None, *list(c)[:200:20]]:
        assert abs(sum(p(before, w) for w in c) + p(before, b"never seen") - 1) < 1e-9
    off, total = 0, 0
    for r in QUERIES["op8_lm_scores"](spark, sf).collect():
        w = toks[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id not in train, len(w), sum(c[x] > 0 for x in w), n)
        single = [(c[x] + 1) / (n + v + 1) for x in w]
        assert abs(sum(map(math.log10, single)) - r.base_score) < 1e-9 * len(w) + 1e-9
        score = sum(math.log10(p(w[k - 1] if k else None, x)) for k, x in enumerate(w))
        off += abs(r.score - score) > 0.01 * len(w)
        total += abs(r.score - score) / len(w)
    assert off <= 0.05 * len(toks) and total <= 0.005 * len(toks)  # the filter seldom makes up


def test_lm_is_the_same_on_any_cluster(spark, sf, monkeypatch):
    """Neither shards nor the words that are dealt to all slices change a score."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").withColumn("held_out", lm.held_out(F.col("doc_id")))
    want = {r.doc_id: r.score for r in lm.scored(docs).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert {r.doc_id: r.score for r in lm.scored(docs).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    monkeypatch.setattr(lm, "heavy_words", lambda docs, rows, slices: [])
    few = {r.doc_id: r.score for r in lm.scored(docs).collect()}
    assert sum(abs(few[i] - want[i]) > 0.05 * abs(want[i]) for i in want) <= 0.05 * len(want)


def test_lm_tells_what_it_has_seen(spark):
    import random

    rng = random.Random(9)
    some = lambda n: " ".join("w%x" % int(3000 * rng.random() ** 2) for _ in range(n))
    once, twice, never = [some(80) for _ in range(100)], [some(80) for _ in range(30)], [some(80) for _ in range(60)]
    texts = [(t, False) for t in once] + [(t, False) for t in twice * 2] + [(t, True) for t in never] + [(t, True) for t in twice]
    got = lm.scored(spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(texts)], "doc_id bigint, text string, held_out boolean")).collect()
    gain = {r.doc_id: (r.score - r.base_score) / r.n_tokens for r in got}
    first, copies, held, held_copies = ([gain[i] for i in range(a, b)] for a, b in ((0, 100), (100, 160), (160, 220), (220, 250)))
    assert max(held) < min(copies) and max(held) < min(held_copies) and sum(g > max(first) for g in copies) >= 0.95 * len(copies)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_lm_perplexity_of_held_out_texts(spark):
    got = QUERIES["op8_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_of_odd_rows(spark, odd):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known) for r in lm.scored(odd.withColumn("held_out", lm.held_out(F.col("doc_id")))).collect())
    assert [x[:3] for x in got] == [(False, 0, 1), (False, 0, 27), (True, 2, 28), (True, 4, 3), (True, 4, 27), (True, 4, 27), (True, 9, 1)]


def test_lm_filter():
    import random

    rng = random.Random(4)
    keys = np.array([rng.getrandbits(64) for _ in range(3000)], "u8")
    counts = np.array([int(1 + 1000 * rng.random() ** 4) for _ in range(3000)], "i8")
    model = lm.Filter.of(keys, counts)
    got, want = model.levels(keys), lm.level(counts)
    assert (got >= want).all() and (got == want).mean() > 0.95
    assert (lm.count_of(want) <= counts).all() and (counts <= 1.5 * lm.count_of(want)).all()
    assert (model.levels(np.array([rng.getrandbits(64) for _ in range(3000)], "u8")) > 0).mean() < 0.03


def test_lm_filter_grows_with_its_entries():
    """A slice of many bigrams tells them as well as one of few."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 500_000, dtype="u8"))
    model = lm.Filter.of(keys, np.ones(len(keys), "i8"))
    assert 8 * len(model.data) >= lm.BITS_AN_ENTRY * len(keys)
    assert (model.levels(rng.integers(0, 1 << 63, 20_000, dtype="u8")) > 0).mean() < 0.03


def test_id_files(spark, sf, rows, ids):
    at = 0
    got = {r.doc_id: r for r in QUERIES["op9_id_files"](spark, sf).collect()}
    for i, _ in rows:
        full = ids[i] + [idfile.END_ID]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(full), zlib.crc32(np.array(full, "<u4").tobytes()))
        at += len(full)


def test_id_file_access(spark, sf, rows, ids, odd, tmp_path):
    idfile.write(spark.read.parquet(f"{sf}/documents.parquet"), f"{tmp_path}/f")
    for i, _ in (rows[0], rows[20], rows[-1]):
        assert idfile.lookup(spark, f"{tmp_path}/f", i) == [ids[i] + [2]]
    assert idfile.lookup(spark, f"{tmp_path}/f", -1) == []
    idfile.write(odd, f"{tmp_path}/g")
    got = sorted((r.start, r.doc_id) for r in idfile.read(spark, f"{tmp_path}/g").collect())
    assert [d for _, d in got] == [None, None, 2, 4, 4, 4, 9]


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 32])
def test_bit_packing(bits):
    rng = np.random.default_rng(bits)
    v = rng.integers(0, 1 << bits, 1000, dtype="u8").astype("<u4")
    data = idfile.pack(v, bits)
    assert len(data) == -(-1000 * bits // 8) and idfile.unpack(data, 0, 1000, bits).tolist() == v.tolist() and idfile.unpack(data, 333, 101, bits).tolist() == v[333:434].tolist()


def brute_components(rows):
    sets = {i: shingles(t, 4, lower=True) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in names}


def test_jaccard(spark, sf, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_ngram_jaccard"](spark, sf).collect()}
    want = brute_components(rows)
    assert got == want and sum(i != c for i, (_, c) in want.items()) > 20


@pytest.mark.parametrize("finer", [0, 1, 3])
def test_jaccard_in_many_blocks(spark, sf, rows, monkeypatch, finer):
    """Blocks, pivots and columns so small that every part of the scan of large clusters is met."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = docs.select("text").mapInArrow(jaccard._whole, "key bigint, shingles array<bigint>").dropDuplicates(["key"])
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    monkeypatch.setattr(jaccard, "FINER", finer)
    monkeypatch.setattr(jaccard, "COPIES", 0 if finer else 16)
    large = found.where(F.size("shingles") > 30)
    edges = jaccard.heavy_links(large)
    names = {r.key: frozenset(r.shingles) for r in large.collect()}
    label = {r.id: r.component for r in components(edges).collect()}
    parent = {k: k for k in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in names:
        for b in names:
            if a < b and 100 * len(names[a] & names[b]) >= 85 * len(names[a] | names[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {k: label.get(k, k) for k in names} == {k: find(k) for k in names}
    assert len({find(k) for k in names}) < len(names)


def templated(spark, n, seed=11):
    """Texts dealt from 200 phrases of five words: lists join them all into one cluster."""
    rng = np.random.default_rng(seed)
    phrases = [" ".join(f"p{i}x{k}" for k in range(5)) for i in range(200)]
    made = [" ".join(phrases[k] for k in rng.integers(0, 200, 14)) for _ in range(n)]
    made += [t + " more" for t in made[: n // 50]]
    return spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string").repartition(4), made


def test_jaccard_of_a_templated_corpus(spark, monkeypatch):
    """One cluster of everything: exact, and what is scanned grows about as the corpus."""
    rows, scan = [], jaccard._scan
    monkeypatch.setattr(jaccard, "_scan", lambda units: (rows.append(units.count()), scan(units))[1])
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 64)
    met = []
    for n in (1500, 4500):
        docs, made = templated(spark, n)
        got = {r.doc_id: r.component_id for r in jaccard.clustered(docs).collect()}
        met.append(sum(rows) / len(made))
        rows.clear()
        if n == 1500:
            want = brute_components(list(enumerate(made)))
            assert got == {i: c for i, (_, c) in want.items()}
        assert all(got[n + k] == got[k] for k in range(n // 50))
    assert max(met) < 2 + jaccard.prefix(70), met  # a set is in its cluster's block and on the lists of its first shingles


def test_hot_shingles_subsets_and_keys(spark, sf, rows, monkeypatch):
    """The same groups where every key that occurs more than eight times travels as a hot one."""
    import tickvault.llm.graph as graph

    monkeypatch.setattr(graph, "FEW", 0)
    monkeypatch.setattr(jaccard, "SAMPLED", 1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_ngram_jaccard"](spark, sf).collect()}
    assert got == brute_components(rows)


def test_jaccard_of_odd_rows(odd):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.clustered(odd).collect())
    assert got == [(False, 0, 0, None), (False, 0, 23, 2), (True, 2, 24, 2), (True, 4, 1, 4), (True, 4, 23, 2), (True, 4, 23, 2), (True, 9, 0, 9)]


def test_boundary_and_sizes():
    assert jaccard.needed(7, 8) == 7 and list(jaccard.partners(20)) == list(range(17, 24))
    assert jaccard.boundary({n: 10 for n in range(1, 40)}) >= 6 and jaccard.boundary({}) == 0
    for n in range(1, 30):
        for m in jaccard.partners(n):
            if jaccard.needed(n, m) <= min(n, m):
                assert jaccard.needed(n, m) in jaccard.subset_sizes(n) and jaccard.needed(n, m) in jaccard.subset_sizes(m)


def test_components(spark):
    import random

    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(500 + rng.randrange(30), 500 + rng.randrange(30)) for _ in range(20)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {k: v for k, v in parent.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_pipeline(spark, sf, rows, library):
    kept = {r.doc_id for r in quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")).where(quality.passes("v1")).collect()}
    left = [(i, t) for i, t in rows if i in kept]
    comp = brute_components(left)
    left = [(i, t) for i, t in left if comp[i][1] == i]
    seen, texts = set(), {}
    for i, t in left:
        w = split(t)
        gone = [0] * len(w)
        for k in range(len(w) - 19):
            x = tuple(w[k : k + 20])
            if x in seen:
                gone[k : k + 20] = [1] * 20
            seen.add(x)
        texts[i] = b" ".join(x for x, g in zip(w, gone) if not g).decode() if any(gone) else t
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    packing_holds(corpus_pipeline.run(spark, sf).collect(), want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "packing"]


def test_stages_return_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def clashing(df, names):
    """The table with more columns, named like whatever an operator may use inside."""
    return df.select("*", *[F.lit("mine").alias(n) for n in names if n not in df.columns])


NAMES = "row w h l k _t _w _lines _s _p _h stay stays digest key cluster component unit side shard _shard n_words n_removed kept failure_bits word_chars n_shingles held_out range guest lows part_no rank _in _before length offset start sets n room places list of turns".split()


def test_columns_with_any_names(spark, sf):
    docs = clashing(spark.read.parquet(f"{sf}/documents.parquet").drop("n_words", "ids", "key", "shard", "kept"), NAMES)
    plain = docs.select("doc_id", "text")
    mine = [n for n in NAMES if n in docs.columns]
    made = {
        "ledger": quality.ledger(docs).select("doc_id", "failure_bits"),
        "sketch": fingerprint.with_sketch(docs, "text", "sketch").select("doc_id", "sketch"),
        "next": fingerprint.with_next(docs).select("doc_id", "guest"),
        "dedup": substring.deduplicated(docs, carry=True).select("doc_id", "n_removed"),
        "trie": bpe.encode_decode(docs).select("doc_id", "n_tokens"),
        "pieces": packing.packed(packing.pieces(docs)).select("doc_id", "length"),
        "jaccard": jaccard.clustered(docs).select("doc_id", "component_id"),
        "lm": lm.scored(docs.withColumn("held_out", F.lit(False))).select("doc_id", "n_tokens"),
    }
    same = {
        "ledger": quality.ledger(plain).select("doc_id", "failure_bits"),
        "sketch": fingerprint.with_sketch(plain, "text", "sketch").select("doc_id", "sketch"),
        "next": fingerprint.with_next(plain).select("doc_id", "guest"),
        "dedup": substring.deduplicated(plain).select("doc_id", "n_removed"),
        "trie": bpe.encode_decode(plain).select("doc_id", "n_tokens"),
        "pieces": packing.packed(packing.pieces(plain)).select("doc_id", "length"),
        "jaccard": jaccard.clustered(plain).select("doc_id", "component_id"),
        "lm": lm.scored(plain.withColumn("held_out", F.lit(False))).select("doc_id", "n_tokens"),
    }
    for name, df in made.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, same[name].collect())), name
    assert fingerprint.with_sketch(docs, "text", "sketch").where(" or ".join(f"`{n}` <> 'mine'" for n in mine)).isEmpty()


def test_stages_carry_columns_of_any_names(spark, sf):
    docs = clashing(spark.read.parquet(f"{sf}/documents.parquet").drop("n_words", "ids", "key", "shard", "kept"), NAMES)
    mine = [n for n in NAMES if n in docs.columns]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns, name
        assert got.where(" or ".join(f"`{n}` is null or `{n}` <> 'mine'" for n in mine)).isEmpty(), name
        assert not got.isEmpty()


def test_stage_keeps_one_row_of_each_group(spark, odd):
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = spark.createDataFrame([(1, t), (4, t), (4, "other text"), (4, "other text"), (None, t), (None, "alone of all these"), (None, "alone of all these"), (8, None), (8, None), (None, "")], "doc_id bigint, text string")
    got = corpus_pipeline.ngram_jaccard(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, ""), (0, "alone of all these"), (1, t), (4, "other text"), (8, ""), (8, "")]
    assert corpus_pipeline.ngram_jaccard(spark, odd, "").count() == 4


def test_very_long_text(spark):
    """One text of a million words among short ones, in every operator on documents."""
    import random

    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(300_000))
    docs = spark.createDataFrame([(1, "short one"), (2, long), (3, "a " + long), (4, None)], "doc_id bigint, text string")
    assert quality.ledger(docs).agg(F.max("n_words")).first()[0] == 300_001
    near = fingerprint.with_sketch(docs, "text", "s").alias("a").crossJoin(fingerprint.with_sketch(docs, "text", "s").alias("b")).where("a.doc_id = 2 and b.doc_id = 3")
    assert near.select(fingerprint.likeness(F.col("a.s"), F.col("b.s"))).first()[0] > 0.99
    assert {r.doc_id: r.n_removed for r in substring.deduplicated(docs).collect()} == {1: 0, 2: 0, 3: 300_000, 4: 0}
    assert {r.doc_id: r.component_id for r in jaccard.clustered(docs).collect()} == {1: 1, 2: 2, 3: 2, 4: 4}
    assert lm.scored(docs.withColumn("held_out", F.lit(False))).agg(F.max("n_tokens")).first()[0] == 300_002
    assert packing.packed(packing.pieces(docs)).agg(F.max("length")).first()[0] == 2048


def test_rows_of_other_operators(spark, odd, library):
    """Null ids and repeated rows in the operators that work row by row."""
    texts = [r.text or "" for r in odd.collect()]
    got = bpe.encode_decode(odd)
    assert sorted(r.decoded for r in got.collect()) == sorted(texts)
    assert sorted(r.n_tokens for r in got.collect()) == sorted(len(library.encode(t).ids) for t in texts)
    led = {(r.doc_id, r.text or "", r.n_words, r.failure_bits & 1) for r in quality.ledger(odd).collect()}
    assert led == {(r.doc_id, r.text or "", len(split(r.text)), int(len(split(r.text)) < 20)) for r in odd.collect()}


def test_words_of_the_contracts():
    assert split("a\x0bb\x0cc\rd\te\nf g\x1ch\xa0i") == re.findall(rb"[^\x20\x09-\x0D]+", "a\x0bb\x0cc\rd\te\nf g\x1ch\xa0i".encode())
