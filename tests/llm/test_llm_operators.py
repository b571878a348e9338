"""The pipeline operators against plain Python, on small tables with nulls, repeats, ties and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telhado.llm import bitslice, decontaminate, graph, pieces, quality, simhash, tokencounts, tokenfiles, toxicity, warc, wrappers
from telhado.llm.common import training_rows
from telhado.llm.queries import definition, model_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MODEL = "piece_bpe_32k.model"
BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
ODD = [
    "", None, " ", "a", "a  b", "\n\n", "x\n y", " lead", "trail ", "don't stop, it's <|endoftext|> here!", "ÉÀ naïve ﬁ",
    "漢字 かな", "tab\there", "é combining", "nbsp\xa0here  two", "<s> </s> ▁mark", "😀 " * 40, "word" * 3000,
]


def docs_of(spark, texts, start=0):
    rows = [(start + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("key", F.lit("k"))


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints):
    """Smallest position reachable by links of at most three bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components(spark):
    texts = ODD + ["the quick brown fox jumps over the lazy dog " * 9, "The QUICK brown fox jumps over the lazy dog " * 9] + ["one two"] * 5
    found = by_id(simhash.near_duplicates(docs_of(spark, texts)))
    prints = [plain_fingerprint(t) for t in texts]
    assert [int(found[i]["fingerprint"], 16) for i in range(len(texts))] == prints
    assert [found[i]["component_id"] for i in range(len(texts))] == plain_components(prints)


@pytest.mark.parametrize("long_posting", [2, 256])
def test_links_connect_all_within_three_bits(spark, long_posting):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(25)]
    prints += [rng.getrandbits(64) for _ in range(50)] + centres[:2] * 3
    table = spark.createDataFrame([(i, simhash._signed(p)) for i, p in enumerate(prints)], "doc_id long, fp long")
    classes = {r["fp"]: r["component_id"] for r in simhash.classes(table, long_posting).collect()}
    assert [classes[simhash._signed(p)] for p in prints] == plain_components(prints)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_one_document_of_each_group_stays(spark):
    docs = docs_of(spark, ["same text here again", "same text here again", "other words are these", None, ""])
    docs = docs.unionByName(docs.where("doc_id = 2")).unionByName(docs.where("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


def test_piece_encoding_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(MODEL))
    rng = random.Random(1)
    parts = ["a", "the", "▁", " ", "  ", "\n", "e", "ñ", "漢", "😀", "ing", " th", "1", "\t", "ﬁ", "<s>", "—", "x" * 5]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(800)]
    want = [library.encode(t or "") for t in texts]
    docs = docs_of(spark, texts)
    encoded = pieces.encode(docs, model_bytes(MODEL))
    assert [r["ids"] for _, r in sorted(by_id(encoded).items())] == want
    back = by_id(pieces.decode(encoded, model_bytes(MODEL)))
    assert [back[i]["text"] for i in range(len(texts))] == [library.decode(w) if w else "" for w in want]
    trip = by_id(pieces.round_trip(docs, model_bytes(MODEL)))
    assert [trip[i]["ids_crc32"] for i in range(len(texts))] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    assert [r["token_ids"] for _, r in sorted(by_id(pieces.add_tokens(docs, model_bytes(MODEL))).items())] == want


def test_token_files(spark, tmp_path):
    library = Tokenizer.from_str(definition(BYTES))
    texts = ODD + ["b. c! (d) e's 1? ²; x* "] * 3
    docs = docs_of(spark, texts)
    found = by_id(tokenfiles.read(tokenfiles.write(docs, definition(BYTES), str(tmp_path / "tokens")), keep_ids=True))
    at = 0
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids"]) == (at, len(ids), ids), t
        assert found[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    none = docs.limit(0)
    assert tokenfiles.read(tokenfiles.write(none, definition(BYTES))).isEmpty()
    repeated = docs.where("doc_id in (3, 4)").unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    rows = tokenfiles.read(tokenfiles.write(repeated, definition(BYTES))).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 3, 3, 4]
    # The least id is no null; an id of many texts is cut into several files.
    ids = [-(1 << 63), None, None, 1, *[7] * 400, 9]
    hot = spark.createDataFrame([(d, f"text {i}") for i, d in enumerate(ids)], "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = tokenfiles.write(hot, definition(BYTES))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["documents"] for r in manifest.collect()) < 200
    rows = tokenfiles.read(manifest, keep_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(ids, key=lambda d: (d is not None, d))
    want = sorted(library.encode(f"text {i}", add_special_tokens=False).ids + [0] for i in range(len(ids)))
    assert sorted(r["ids"] for r in rows) == want
    ends = [r["start"] + r["n_tokens"] for r in rows]
    assert [0, *ends[:-1]] == [r["start"] for r in rows]


@pytest.mark.parametrize("chunk", [40, 16_384])
def test_token_counts(spark, chunk):
    library = Tokenizer.from_str(definition(WORDS))
    long = " ".join(f"word{i % 91}, it's <|endoftext|> {i}" for i in range(2000))
    texts = [*ODD, long, "nospace" * 900, "ΑΣ ΣΑΣ\n" * 50]
    found = by_id(tokencounts.count(docs_of(spark, texts), definition(WORDS), chunk=chunk))
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert tuple(found[i])[1:] == (len((t or "").encode()), n, n > 2048), t


def test_leaks_stand_substitutions(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    item = [rng.choice(vocabulary) for _ in range(30)]
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def altered(words, places):
        return [f"zz{i}" if i in places else w for i, w in enumerate(words)]

    texts = [
        " ".join(noise(40) + item + noise(9)),
        " ".join(noise(3) + altered(item, {1, 9, 17, 25}) + noise(5)).upper(),
        ", ".join(item[5:18]),
        " ".join(noise(20) + item[:10] + noise(20)),
        " ".join(altered(item, set(range(0, 30, 3)))),
        " ".join(noise(200)),
        None,
        "",
        " ".join(["short", "item", "here", "now"]),
    ]
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, ""), (9, None), (10, "short item here now"), (7, " ".join(item))], "item_id long, text string")
    docs = docs_of(spark, texts)
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, benchmark).collect()}
    assert set(found) == {(0, 7), (1, 7), (2, 7), (8, 10)}
    assert (found[0, 7]["equal_words"], found[0, 7]["n_words"], found[0, 7]["start_word"]) == (30, 30, 40)
    kept = decontaminate.keep_unseen(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.leaks(docs, benchmark.limit(0)).isEmpty()
    assert decontaminate.leaks(docs.limit(0), benchmark).isEmpty()


def test_leaks_of_repeated_and_null_ids(spark):
    """Rows that share an id, or have none, lose no leak, also where their stretches begin at the same word."""
    rng = random.Random(5)
    items = [[f"{c}{i}" for i in range(20)] for c in "ab"]
    rows = [(1, " ".join(["x"] * 30 + item + [rng.choice("yz")] * 30), "en", "s", 0) for item in items]
    rows += [(None, rows[0][1], "en", "s", 0), (2, "clean text", "en", "s", 0), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    found = sorted((str(r["doc_id"]), r["item_id"], r["equal_words"]) for r in decontaminate.leaks(docs, benchmark).collect())
    assert found == [("1", 0, 20), ("1", 1, 20), ("None", 0, 20)]
    assert [r["doc_id"] for r in decontaminate.keep_unseen(docs, benchmark).collect()] == [2]


def test_training_rows_stay_bounded(spark):
    """An id that repeats very often is learnt from once."""
    docs = spark.range(5000).selectExpr("1L AS doc_id", "concat('t', id % 7) AS text").unionByName(
        spark.createDataFrame([(2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    )
    sample = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, label int")
    assert sorted(map(str, map(tuple, training_rows(docs, sample).collect()))) == ["(0, 't6')", "(1, 'c')", "(1, None)"]


def test_masks_miss_no_two_substitutions():
    from itertools import combinations

    windows = [frozenset(p + o for o in m) for m in decontaminate.MASKS for p in range(decontaminate.RUN - m[-1])]
    assert all(any(not w & set(c) for w in windows) for c in combinations(range(decontaminate.RUN), 2))


def labelled(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic, poor = i % 5 == 0, i % 7 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["Vermin", "dunghead"])
        lines = [" ".join(text[k : k + 12]) for k in range(0, len(text), 12)]
        if poor:
            lines = [" ".join(w + "%%%" for w in line.split()).upper() for line in lines]
        docs.append((i, "\n".join(lines), "en", "s", 0))
        labels.append((i, int(not poor), int(toxic)))
    docs += [(9000, None, "en", "s", 0), (9001, "", "en", "s", 0), (None, "plain words", "en", "s", 0), (9001, "", "en", "s", 0)]
    labels += [(9001, None, None), (None, 1, 1)]
    return (
        spark.createDataFrame(docs, DOCS).withColumn("label", F.lit("x")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("module,label,limit", [(toxicity, "toxic", 0.5), (quality, "quality", 0.3)])
def test_classifiers_on_held_out_rows(spark, module, label, limit):
    docs, labels = labelled(spark)
    rows = module.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None and r["doc_id"] is not None]
    assert len(held) > 60 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= limit) for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    keep = module.keep_clean if module is toxicity else module.keep_good
    wanted = sorted(str(r["doc_id"]) for r in rows if r["predicted"] == (module is quality))
    kept = keep(docs, labels)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == wanted
    assert module.classify(docs.limit(0), labels).isEmpty()
    assert module.classify(docs, labels.limit(0)).count() == docs.count()


def test_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    for n in (1, 2, 5):
        evidence, switch = rng.normal(size=n), rng.normal(size=(2, 2))
        weight = {y: np.exp(sum(e for e, g in zip(evidence, y) if g) + sum(switch[a, b] for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=n)}
        want = [sum(w for y, w in weight.items() if y[t]) / sum(weight.values()) for t in range(n)]
        assert quality.marginals(evidence, np.zeros(n, int), switch) == pytest.approx(want)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><article>x";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a>x</a></li><li>y</li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="sidebar"><p>side</p></div><main><article><header><h1>Title&nbsp;&amp; more</h1></header><p>First  <b>bo</b>ld&#33; <i>it</i>
<p>{}<div class="ad">buy</div><ul><li>one<li>two</ul><form><input>q<button>go</button></form>tail &am<script>x</script></article>
<section class="comments"><article class="comment"><p>reader</p></article></section></main><aside>rel</aside><footer>&copy;</footer></body></html>"""


def test_pages(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.format(f"Second {i}")) for i in range(30)]
    rows += [(50, "http://host.example/50", PAGE.format("cut")[:560]), (51, None, None), (52, "", ""), (53, "x", "bare <b>text</b>"), (0, *rows[0][1:])]
    rows += [(60 + i, "http://plain.example/", f"<div><p>Same line</p></div><div><p>Own {i}</p></div>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    found = wrappers.extract(pages.repartition(5)).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    for i in range(30):
        assert text[i] == f"Title & more\nFirst bold! it\nSecond {i}\none\ntwo\ntail &am"
    assert text[50].startswith("Title & more\nFirst bold! it"[:12])
    assert (text[51], text[52], text[53]) == ("", "", "bare text")
    assert text[62].endswith("Own 2")
    assert wrappers.extract(pages.limit(0)).isEmpty()


def test_wrappers_have_slots_options_and_repeats():
    a, b = (wrappers.wrapper_of(wrappers.parse(x)) for x in ("<ul><li>1<li>2</ul><p>x", "<ul><li>1</ul><h2>t</h2><p>y"))
    assert wrappers.expression(wrappers.align(a, b)) == "<ul><li>#</>+</><h2>#</>?<p>#</>"


def read_host(pages):
    whole = None
    for page in pages:
        own = wrappers.wrapper_of(wrappers.parse(page))
        whole = wrappers.align(whole, own) if whole else own
    how = wrappers.unpacked(wrappers.packed(wrappers.plan(wrappers.unpacked(wrappers.packed(whole)))))
    return [wrappers.main_text(page, how) for page in pages]


def test_constant_elements_go_by_their_place():
    site = "<body><div>Site name</div><h1>Title {0}</h1><div>own article {0}</div></body>"
    assert read_host([site.format(c) for c in "abcdefg"]) == [f"Title {c}\nown article {c}" for c in "abcdefg"]
    # Copies of one page, with other markup around the same texts, are no evidence.
    assert read_host([f'<h1 data-n="{i}">T</h1><p>text</p>' for i in range(9)]) == ["T\ntext"] * 9
    # Nor are repeats within one page; what would leave a page empty stays.
    assert read_host(["<ul>" + "<li>same</li>" * 9 + "</ul>"] * 2)[0].count("same") == 9
    rest = [f"<div>Site name</div><h2>{c}</h2>" for c in "abcde"]
    assert read_host([*rest, "<div>Site name</div>"]) == [*"abcde", "Site name"]
    # Optional and repeated elements around it do not move the place.
    odd = [f"<div>Site name</div>{'<h2>s</h2><p>x' + c + '</p>' if c in 'ace' else ''}<h1>T{c}</h1>" + f"<p>{c}</p><pre>{c}</pre>" * (ord(c) % 3 + 1) for c in "abcdefg"]
    for c, text in zip("abcdefg", read_host(odd)):
        assert text == "\n".join(([f"s\nx{c}"] if c in "ace" else []) + [f"T{c}"] + [c] * 2 * (ord(c) % 3 + 1))


@pytest.mark.parametrize("depth", [200, 3000])
def test_pages_of_any_depth(depth):
    page = "<body><div><article><h1>T {0}</h1>{1}deep {0}<nav>menu</nav><form>f</form>{2}<p>rest {0}</p></article></div><p>out</p>"
    for tag in ("div", "blockquote"):
        pages = [page.format(c, f"<{tag}>" * depth, f"</{tag}>" * depth) for c in "abc"]
        assert read_host(pages) == [f"T {c}\ndeep {c}\nrest {c}" for c in "abc"]
    # Never closed, and without an element for the article.
    assert read_host(["<div>" * depth + f"own {c}<aside>x</aside></p></section>" for c in "abcdef"]) == [f"own {c}" for c in "abcdef"]


def test_ambiguous_words_in_an_article_need_the_wrapper():
    page = """<main><article><h1>T {0}</h1><section id="discussion"><p>dis {0}</p></section><h2 id="related-work">Work</h2><p>w {0}</p>
<section id="search-strategy"><p>s {0}</p></section><div class="legal-basis">law {0}</div><div id="ad-hoc-networks">hoc {0}</div>
<div class="social">Follow us</div><div class="related"><h3>See</h3><ul><li>r {0}</li><li>q {0}</li></ul></div><div class="ad-box">buy {0}</div>
<div class="reply">one {0}</div><div class="reply">two {0}</div><p>end {0}</p></article></main>"""
    for c, text in zip("abcdef", read_host([page.format(c) for c in "abcdef"])):
        assert text == f"T {c}\ndis {c}\nWork\nw {c}\ns {c}\nlaw {c}\nhoc {c}\nend {c}"
    # No evidence on a host of one page; without an article element anchors do not count either.
    assert read_host(['<article><p>a</p><div class="social">b</div></article>']) == ["a\nb"]
    assert read_host(['<h2 id="legal">a</h2><section id="responses"><p>b</p></section><div class="search">c</div>']) == ["a\nb"]


def test_headers_of_articles_and_comments_in_code():
    """A header with a heading is the article's, one that is the same on all pages the host's; classes in code name tokens."""
    for page in (
        '<div class="post"><div class="post-header"><h1>T {0}</h1></div><p>text {0}</p></div><div class="header">Site</div>',
        "<header>Site</header><main><header><h2>T {0}</h2></header><p>text {0}</p></main>",
    ):
        assert read_host([page.format(c) for c in "abcdef"]) == [f"T {c}\ntext {c}" for c in "abcdef"]
        assert read_host([page.format("a")]) == ["T a\ntext a"]
    host = '<div id="main"><div class="header"><h1>Site</h1></div><header>menu {0}</header><p>text {0}</p></div>'
    assert read_host([host.format(c) for c in "abcdef"]) == [f"text {c}" for c in "abcdef"]
    code = """<article><p>a</p><code>x = 1 <span class="comment"># set</span></code><span class="ad">buy</span>
<pre>y <i class="cm comment">/* y */</i><span hidden>1</span> z</pre><p><code>open <b class="comment">b</b></p><p>c <span class="ad">buy</span></article>"""
    assert read_host([code]) == ["a\nx = 1 # set\ny /* y */ z\nopen b\nc"]


def test_archives(spark):
    big, small = "<p>é" * 400, "tiny"
    rows = [(1, "http://a/x?q=1", big), (2, "http://a/ü", big), (3, None, small), (4, "http://b/", small), (5, "http://c/", None)]
    rows += [(6, "http://d/", "other" * 300), (2, "http://a/ü", big), (None, "http://e/", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("mine"))
    manifest = warc.write(pages)
    found = warc.captures(warc.records(manifest, keep_payload=True))
    assert all(r["capture"] and r["request"] and r["metadata"] for r in found.collect())
    got = sorted(tuple(r) for r in warc.page_rows(warc.captures(warc.records(manifest))).na.fill(-1, ["page_id", "refers_to"]).collect())
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        revisit = html == big and page_id != 2
        want.append((page_id or -1, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", 2 if revisit else -1))
    assert got == sorted(want)
    assert warc.page_rows(warc.captures(warc.records(warc.write(pages.limit(0))))).isEmpty()


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = np.round(rng.normal(size=(260, 7)), 2)
    vectors[5:40] = vectors[5]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300, None), (301, [1.0, None]), (400, [float("nan")] * 7), (500, [float("inf")] * 7), (None, [1.0] * 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(0)).withColumn("block", F.lit(0))
    whole = np.floor(1024 * vectors.astype(np.float32).astype(np.float64)).astype(np.int64)
    want = set()
    for q in (0, 100, 200):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(260), -score)) if i != q][:10]
        want |= {(q, n, int(i), int(score[i])) for n, i in enumerate(order, 1)}
    for block, group in ((8192, 8192), (50, 1)):
        assert {tuple(r) for r in bitslice.top_k(table, block_rows=block, query_rows=group).collect()} == want
    few = table.where("vec_id in (0, 1, 2)")
    assert bitslice.top_k(few).count() == 2 and bitslice.top_k(table.limit(0)).isEmpty()


def test_pipeline_keeps_columns_and_decides(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == columns, name
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()}, name
        before = spark.createDataFrame(after.toPandas(), docs.schema)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*columns, "token_ids"] and {r["doc_id"] for r in out.collect()} == ids
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    assert all(r["token_ids"] == library.encode(r["text"]) for r in out.collect())


def test_special_token_keeps_stretches_apart():
    from telhado.llm.common import Apart, split_words

    library = Tokenizer.from_str(definition(BYTES))
    stretches = [" a", "b.", "", "<|endoftext|>", "<| x", " don't", "漢"] * 3
    packed = Apart(library).encode(stretches, np.dtype("<u2"))
    assert [np.frombuffer(p, "<u2").tolist() for p in packed] == [library.encode(s, add_special_tokens=False).ids for s in stretches]
    codes, offsets, words = split_words(pa.array(["a b", None, "", "b"]))
    assert [[words[c] for c in codes[a:z]] for a, z in zip(offsets, offsets[1:])] == [["a", "b"], [""], [""], ["b"]]


def test_top_k_of_one_id_with_many_rows(spark):
    # One id of many rows, some equal: more than one block has it, and equal rows are told as often as they are.
    hot = [(7, [0.01 * i, 1.0]) for i in range(60)] + [(7, [9.0, 9.0])] * 14 + [(100, [1.0, 1.0]), (5, [10.0, 10.0])]
    hot = spark.createDataFrame(hot, "vec_id long, embedding array<double>")
    plan = bitslice.top_k(hot, block_rows=16)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"xxhash64\(vec_id#\d+L, v#\d+", plan)
    got = [tuple(r) for r in bitslice.top_k(hot, k=12, block_rows=16).orderBy("rank").collect()]
    assert got == [(100, 1, 5, 20 * 1024**2)] + [(100, i, 7, 18 * 1024**2) for i in range(2, 13)]


def test_text_without_splices_is_encoded_a_bounded_number_of_times():
    seen = []

    def encode(text):
        seen.append(len(text))
        return [(0, i, i + 1) for i in range(len(text))]

    assert tokencounts.spliced_count("x" * 100_000, encode, chunk=1000) == 100_000
    assert sum(seen) <= 4 * 100_000


def test_quality_learns_from_long_and_null_texts(spark):
    good = "\n".join(f"The river ran past the old mill {i} and on to the sea." for i in range(900))
    poor = "\n".join(f"BUY NOW!!! $$$ {i} *** CLICK ### HERE" for i in range(900))
    rows = [(i, good + f"\n{i}" if i % 2 else poor + f"\n{i}", "en", "s", 0) for i in range(1, 25)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2) for i in range(1, 25)], "doc_id long, quality int")
    scores = by_id(quality.classify(docs, labels))
    assert all(scores[i]["predicted"] == i % 2 and abs(scores[i]["score"] - 0.5) > 0.3 for i in range(1, 25))
    lines = np.arange(1000).reshape(-1, 1)
    assert len(quality._stretch(lines, b"x")) == quality.FIT_LINES and len(quality._stretch(lines[:7], b"x")) == 7
    assert quality.fit(docs.withColumn("text", F.lit(None).cast("string")), labels).weights.any()
