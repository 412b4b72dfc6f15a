"""Operators against brute force, round trips and held-out accuracy, on small fixtures."""

import base64
import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postwright.llm import (
    decontaminate, html_wrapper, langid, licenses, line_rules, minhash, mixing, secrets, toxicity,
    warc,
)
from postwright.llm.common import WordIds

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return {r["doc_id"]: r for r in documents.collect()}


# ------------------------------------------------------------------ near-duplicates


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def groups(texts):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def found_groups(df):
    return {
        r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
        for r in minhash.components_of(df).collect()
    }


def test_near_duplicates(documents, rows):
    assert found_groups(documents) == groups({k: r["text"] for k, r in rows.items()})


def test_near_duplicates_around_the_threshold(spark):
    rng = random.Random(5)
    texts, number = {}, 0
    for base in range(6):
        words = [f"b{base}w{k}" for k in range(rng.choice([6, 30, 120]))]
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 20))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts[number] = " ".join(copy)
            number += 1
    # a passage that many short documents share without being near
    passage = [f"p{k}" for k in range(60)]
    for _ in range(40):
        own = [f"o{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 70))]
        texts[number] = " ".join(own + passage)
        number += 1
    texts |= {number: "a b", number + 1: "A  B", number + 2: "a b c", number + 3: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert found_groups(df) == groups(texts)


def test_chain_of_links_is_one_component(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (100, 102)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in minhash.connected(df).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(50))
    data = [(1, text, 7), (1, text, 7), (2, text + " more", 8), (3, "other text", 9), (None, text, 1)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, size int")
    stay = minhash.deduplicate(df).collect()
    assert sorted((r["doc_id"], r["size"]) for r in stay) == [(1, 7), (3, 9)]


def test_loss_at_the_threshold_is_small():
    p, n = minhash.SIMILARITY / 100, minhash.COORDINATES
    lost = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(minhash.MATCHES))
    assert lost < 3e-5


def test_signatures_estimate_similarity():
    ids = WordIds()
    a = minhash.shingles(" ".join(f"w{k}" for k in range(3000)), ids)
    b = minhash.shingles(" ".join(f"w{k}" for k in range(600, 3600)), ids)
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - 2 / 3) < 0.2


# ------------------------------------------------------------------ decontamination


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    letters = [f"t{k}" for k in range(6)]
    items = [(k, " ".join(rng.choices(letters, k=rng.choice([0, 2, 5, 10, 14])))) for k in range(12)]
    docs = [(k, "! ".join(rng.choices(letters, k=rng.randrange(0, 60)))) for k in range(60)]
    found = decontaminate.scan(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"), slice_bytes=100,
    ).collect()
    windows = []
    for item, text in items:
        words = text.split()
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.append((str(item), words[k : k + 10]))
    for row in found:
        words = re.findall(r"t\d", docs[row["doc_id"]][1])
        hit, names = set(), set()
        for name, window in windows:
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    names.add(name)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(words), len(hit), len(names))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_spans_are_offsets_of_the_original(spark):
    docs = spark.createDataFrame([(1, "Été: ONE, two; three. x")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    row = decontaminate.scan(docs, items).first()
    assert [(s["start"], s["end"]) for s in row["spans"]] == [(5, 20)]


# ------------------------------------------------------------------ secrets


def der(*parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x81" + bytes([len(body)])
    return b"\x30" + size + body


KEY = der(b"\x02\x01\x00", b"\x02\x81\x81\x00" + bytes(range(1, 129)), b"\x02\x03\x01\x00\x01")


def kinds(text):
    return [k for *_, k in secrets.spans(text)[1]]


def test_key_structures():
    b64 = base64.b64encode(KEY).decode()
    block = f"-----BEGIN PRIVATE KEY-----\n{b64[:64]}\n{b64[64:]}\n-----END PRIVATE KEY-----"
    assert kinds(f"see {block} end") == ["pem"]
    assert kinds(f"see {b64} end") == ["der"]
    assert "der" in kinds(KEY.hex())
    assert kinds(base64.b64encode(KEY[:-1] + b"\x01\x01").decode()) == []  # lengths do not fit
    blob = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
    assert kinds(base64.b64encode(blob).decode()) == ["openssh"]
    assert kinds("a" * 200) == ["hex"]
    assert kinds("aaaaaaaaaB" * 20) == []


def test_signed_tokens():
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 1})}.c2ln"
    assert "jwt" in kinds(f"x {token} y")
    assert kinds(f"{part({'typ': 'JWT'})}.{part({'sub': 1})}.c2ln") == []
    assert kinds("eyJhbGciOiJIUzI1NiJ9.!!") == []


BASE = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
}


def base_by_hand(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        flags = re.I | re.A if kind == "assign" else 0
        for m in re.finditer(pattern, text, flags):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_patterns(documents, rows):
    extra = [
        "token=abc token:abcdefgh", "password = token: abcdefghijk", "APIKEY='0123456789'",
        "ſecret=abcdefghij toKen=abcdefghij", "AKIA" + "A" * 11, "AKIA" + "A" * 12, "é token=12345678",
        "0" * 31 + "g" + "f" * 32,
    ]
    for text in [*extra, *[r["text"] for r in rows.values()]]:
        base, every = secrets.spans(text or "")
        assert secrets._joined(base) == base_by_hand(text or "")
        assert set(base) <= set(every)


def test_redaction(documents):
    assert secrets.redacted('a token = "0123456789" b') == 'a token = "[secret]" b'
    assert secrets.redacted("x " + "f" * 40 + " y") == "x [secret] y"
    clean = secrets.redact(documents)
    left = secrets.scan(clean).filter("n_hex > 0 or n_access > 0").count()
    assert left == 0 and clean.count() == documents.count()


# ------------------------------------------------------------------ toxicity


def test_nearest_are_exact():
    rng = random.Random(2)
    names = [f"t{k}" for k in range(30)]
    idf = {t: 1 + rng.random() for t in names}
    make = lambda: {t: rng.randrange(1, 5) for t in rng.sample(names, rng.randrange(0, 6))}
    index = toxicity.Index(idf, [(make(), rng.randrange(50), float(rng.random() < 0.3)) for _ in range(700)])
    dense = np.zeros((700, 31))
    for k, (at, weights) in enumerate(index.vectors):
        dense[k, at] = weights
    for _ in range(60):
        ids, weights = index.vector({index.names[t]: n for t, n in make().items()}, rng.randrange(50))
        if not len(ids):
            continue
        query = np.zeros(31)
        query[ids] = weights
        cosines = np.round(dense @ query, 12)
        best = np.lexsort((np.arange(700), -cosines))[: toxicity.K]
        best = best[cosines[best] > 0]
        found, values = index.nearest(ids, weights)
        assert np.allclose(values, cosines[best]) and found.tolist() == best.tolist()


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in found)
    clean = [r["predicted"] for r in found if not r["toxic"]]
    toxic = [r["predicted"] for r in found if r["toxic"]]
    assert sum(clean) <= 0.08 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


# ------------------------------------------------------------------ languages


def test_forward_sums_all_segmentations():
    vocabulary = tuple(sorted(["a", "b", "c", "ab", "bc", "abc", "▁", "▁a"]))
    rng = random.Random(4)
    p = np.array([rng.random() for _ in vocabulary])
    p /= p.sum()
    model = langid.Model(["x"], p[None, :], vocabulary)
    chance = dict(zip(vocabulary, p, strict=True))

    def by_hand(word):
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, len(word) + 1):
            head = chance.get(word[:n], langid.UNKNOWN if n == 1 else 0.0)
            total += head * by_hand(word[n:])
        return total

    words = ["▁abc", "▁abcabc", "▁", "▁zab", "▁b"]
    assert np.allclose(model.word_scores(words)[:, 0], [math.log(by_hand(w)) for w in words])


def test_expected_counts_by_hand():
    vocabulary = tuple(sorted(["a", "b", "ab"]))
    p = np.array([0.2, 0.3, 0.5])  # a, ab, b
    lattice = langid.Lattice(vocabulary)
    codes = np.array([[ord("a"), ord("b")]], dtype=np.uint64)
    counts = langid.expected(
        lattice.edges(codes), langid.scaled_rows(p, lattice.longest), 2, 3, np.array([4.0])
    )
    whole, split = 0.3, 0.2 * 0.5
    assert np.allclose(counts, 4 * np.array([split, whole, split]) / (whole + split))


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


# ------------------------------------------------------------------ pages


def page(article, extra="", ad="Buy!"):
    return (
        f"<html><head><title>T</title><script>var x='<p>no</p>';</script></head><body>"
        f"<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad'>{ad}</div>{extra}"
        f"<article>{article}</article><footer>&copy; x</footer></body></html>"
    )


def texts_of(spark, pages):
    data = [(k, u, h) for k, (u, h) in enumerate(pages)]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in html_wrapper.extract(df).collect()}


def test_article_blocks(spark):
    shapes = [
        page("<h1>A &amp; B</h1><p>one\n two<br>three<p><b>four</b> five<ul><li>six<li>seven</ul>"),
        page("<p>a</p><aside>no</aside><form><p>no</p></form><div class='user comments'>no</div>"),
        "<div id=sidebar>no</div><main><p>x &lt;y&gt; &#233;&nbsp;z</main><p>no</p>",
        "plain &amp; simple < text",
        "<p>one<!-- no --><p>two<style>no</style><table><tr><td>c<td>d</table>",
    ]
    found = texts_of(spark, [(f"http://h{k}.example/", h) for k, h in enumerate(shapes)])
    assert found == {
        0: "A & B\none two three\nfour five\nsix\nseven", 1: "a", 2: "x <y> é z",
        3: "plain & simple < text", 4: "one\ntwo\nc\nd",
    }


def test_constant_nodes_are_template(spark):
    bare = (
        "<div><div>Site name</div><div>Menu of the site</div><div><h2>Title {0}</h2>"
        "<p>Text {0} of the page</p><p>More {0}</p></div><div>All about us</div></div>"
    )
    pages = [(f"http://one.example/{k}", bare.format(k)) for k in range(8)]
    # copies of a page do not make its text a template, nor do two pages of a host
    pages += [("http://two.example/x", bare.format("x"))] * 6
    found = texts_of(spark, pages)
    assert found[3] == "Title 3\nText 3 of the page\nMore 3"
    assert found[9].startswith("Site name")


def test_tree_matching_is_the_largest_alignment():
    def tree(shape):
        tags, depths = [], []

        def add(node, depth):
            tags.append(ord(node[0]))
            depths.append(depth)
            for child in node[1:]:
                add(child, depth + 1)

        add(shape, 0)
        return html_wrapper.Tree(
            np.array(tags, dtype="<u4"), np.array(depths), np.zeros(len(tags), dtype="<u8")
        )

    def simple(a, b):
        if a[0] != b[0]:
            return 0
        m, n = len(a) - 1, len(b) - 1
        table = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(1, m + 1):
            for j in range(1, n + 1):
                table[i][j] = max(table[i - 1][j], table[i][j - 1],
                                  table[i - 1][j - 1] + simple(a[i], b[j]))
        return table[m][n] + 1

    rng = random.Random(9)

    def shape(depth):
        return [rng.choice("abc"), *[shape(depth - 1) for _ in range(rng.randrange(4) if depth else 0)]]

    for _ in range(60):
        a, b = shape(3), shape(3)
        b[0] = a[0]
        pairs = html_wrapper.match(tree(a), tree(b))
        assert len(pairs) == simple(a, b)
        assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)

    # lists of any length: greedy pairing would miss the run of "b" behind the "c"
    long_a = ["r", *[["b"]] * 300, *[["a", ["b"]]] * 300]
    long_b = ["r", ["a"], *[["c"]] * 99, *[["b"]] * 300]
    assert len(html_wrapper.match(tree(long_a), tree(long_b))) == 301
    turns = ["r", *[[c] for c in rng.choices("abc", k=250)]], ["r", *[[c] for c in rng.choices("abc", k=250)]]
    assert len(html_wrapper.match(*map(tree, turns))) == simple(*turns)


# ------------------------------------------------------------------ archives


def test_archives_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    again = pages.union(pages.withColumn("page_id", F.col("page_id") + 1000))
    short = spark.createDataFrame([(5000 + k, "http://s/", "x" * 99) for k in range(3)], pages.schema)
    source = again.union(short)
    raw, target = str(tmp_path / "raw"), str(tmp_path / "new")
    found = {r["page_id"]: r for r in warc.archive(source, raw, target).collect()}
    html = {r["page_id"]: r["html"] for r in source.collect()}
    payload = {r["page_id"]: r["payload"] for r in warc.read(spark, raw).collect()}
    assert payload == html
    kept = {r["page_id"]: r["payload"] for r in warc.read(spark, target).collect()}
    for page_id, row in found.items():
        data = html[page_id].encode()
        assert row["payload_bytes"] == len(data)
        assert row["payload_digest"] == hashlib.sha256(data).hexdigest()
        if 1000 <= page_id < 5000 and len(data) >= 100:
            assert (row["record_type"], row["refers_to"]) == ("revisit", page_id - 1000)
            assert kept[page_id] == ""
        else:
            assert (row["record_type"], row["refers_to"]) == ("response", None)
            assert kept[page_id] == html[page_id]


# ------------------------------------------------------------------ lines


def test_frequent_lines(spark):
    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    banner = "We use COOKIES, 12 of them, to make this site a better place for you."
    data = [(k, f"{prose(20)}\n{banner}\n{prose(20)}", "h") for k in range(30)]
    data += [(100 + k, f"{prose(2)}\n{banner}", "h") for k in range(3)]
    copied = f"{prose(30)}\n{prose(30)}\n{prose(30)}"
    data += [(200 + k, copied, "h") for k in range(40)]  # copies are one document
    data += [(300, f"{prose(3)}\n{banner}", "other")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r for r in line_rules.measure(df).collect()}
    gone = {k for k, r in found.items() if not r["kept"]}
    assert gone == {100, 101, 102}
    assert found[0]["n_frequent_words"] == len(banner.split())
    clean = {r["doc_id"]: r["text"] for r in line_rules.filter_documents(df).collect()}
    assert set(clean) == set(found) - gone
    assert banner not in clean[0] and clean[200] == copied and banner in clean[300]


def test_frequent_lines_are_counted_by_documents(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    block = "\n".join(prose(6) for _ in range(4))
    data = [(k, f"{prose(40)}\n{block}", "h") for k in range(30)]  # the block ends each text
    data += [(100, f"{prose(3)}\n{block}", "h")]
    refrain = prose(4)
    verses = "\n".join(f"{prose(20)}\n{refrain}" for _ in range(12))
    data += [(200, verses, "h")]  # one document, in twelve places
    data += [(300 + k, f"{verses}\n{prose(20)}", "h") for k in range(8)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r["n_frequent_words"] for r in line_rules.measure(df).collect()}
    assert {found[k] for k in [*range(30), 100]} == {24}
    assert {found[k] for k in [200, *range(300, 308)]} == {0}
    clean = {r["doc_id"]: r["text"] for r in line_rules.filter_documents(df).collect()}
    assert 100 not in clean and "\n" not in clean[0]


def test_frequent_lines_do_not_depend_on_the_size_of_the_host(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))
    banner, rare = prose(6), prose(6)
    data = [(k, f"{prose(12)}\n{banner}", "h") for k in range(15)]
    data += [(100 + k, f"{prose(12)}\n{rare}", "h") for k in range(9)]
    data += [(200, data[0][1], "h")]
    data += [(1000 + k, prose(12), "h") for k in range(1000)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    found = line_rules.measure(df).filter("n_frequent_words > 0").collect()
    assert {r["doc_id"] for r in found} == {*range(15), 200}


def test_repeated_words_by_hand():
    rng = random.Random(7)
    for _ in range(50):
        words = [rng.choice("ab") for _ in range(rng.randrange(0, 40))]
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        hit = {i for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1
               for i in range(k, k + 5)}
        assert line_rules.counts(" ".join(words), WordIds())[4] == len(hit)


# ------------------------------------------------------------------ licences and mixing


def test_licence_units(spark):
    texts = dict(licenses.TEMPLATES)
    mit = texts["MIT"].strip().replace("\n", " ")
    data = [
        (1, mit), (2, "intro\n\n" + texts["ISC"].strip() + "\n\nend of it"),
        (3, "x\nReleased under the MIT Licence.\nAll rights reserved."),
        (4, mit.replace("Software", "Thing")), (5, "the software is free"),
    ]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    found = {(r["doc_id"], r["unit"], r["license_id"]) for r in licenses.scan(df).collect()}
    assert found >= {
        (1, "line", "MIT"), (2, "paragraph", "ISC"), (3, "line", "Reserved notice"),
    }
    assert not {x for x in found if x[0] == 5}


def test_markers_are_in_every_match():
    rng = random.Random(3)
    words = set(licenses.markers(licenses.TEMPLATES, licenses.THRESHOLD))
    for _, text in licenses.TEMPLATES:
        tokens = re.findall("[a-z0-9]+", text.lower())
        target = licenses._pairs(text)
        for _ in range(30):
            unit = [t for t in tokens if rng.random() > 0.1]
            own = set(zip(unit, unit[1:], strict=False))
            if own and 2 * len(own & target) / (len(own) + len(target)) >= licenses.THRESHOLD:
                assert words & set(unit)


def test_mixture_meets_its_targets(spark):
    rng = random.Random(8)
    data = [
        (k, "t " * rng.randrange(1, 40), "big" if k % 10 < 7 else "mid" if k % 10 < 9 else "tiny")
        for k in range(3000)
    ]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string").cache()
    found = mixing.mix(df, block_rows=16).cache()
    total = sum(len(t.split()) for _, t, _ in data)
    taken = {r["source"]: r for r in found.groupBy("source").agg(
        F.sum("mix_tokens").alias("n"), F.max("mix_weight").alias("w"),
        F.max("mix_epoch").alias("e")).collect()}
    weights = [r["w"] for r in taken.values()]
    entropy = -sum(w * math.log(w) for w in weights)
    assert abs(sum(weights) - 1) < 1e-6
    assert entropy >= mixing.TARGET_ENTROPY * math.log(3) - 1e-4 or taken["tiny"]["e"] >= 3
    for row in taken.values():
        assert row["w"] * total - 41 <= row["n"] <= row["w"] * total + 1e-3
    # a pass takes each document once
    assert found.groupBy("doc_id", "mix_epoch").count().filter("count > 1").count() == 0
    limited = mixing.mix(df, target_entropy=1.0, max_epochs=2.0)
    spent = limited.groupBy("source").agg((F.sum("mix_tokens")).alias("n")).collect()
    own = Counter()
    for _, text, source in data:
        own[source] += len(text.split())
    assert max(r["n"] / own[r["source"]] for r in spent) <= 2.0001
