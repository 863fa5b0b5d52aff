"""Language ID, fingerprints, extraction: planted cases and edges."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm import chunkprints, hostpaths, langid

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out_accuracy(spark, documents):
    prototypes = langid.train(documents.where(~langid.held_out()))
    found = langid.identify(documents, prototypes).where(langid.held_out()).select("lang", "lang_pred", "score").collect()
    assert len(found) > 20 and np.mean([r.lang == r.lang_pred for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(spark, documents):
    prototypes = langid.train(documents)
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !? \n", "x"), (3, "123 !? \n", "x"), (None, "the thing that was", "x"),
            (4, "the of and " * 30000, "x"), (5, "漢字 ру", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = langid.identify(df, prototypes).collect()
    assert [(r.lang_pred, r.score) for r in got[:4]] == [("und", 0.0)] * 4
    assert got[4].lang_pred == got[5].lang_pred == "en" and got[6].lang_pred != "und"
    assert {r.doc_id for r in langid.accepted(df, prototypes).collect()} == {None, 4, 5}
    assert {r.lang_pred for r in langid.identify(df, []).collect()} == {"und"}
    assert langid.train(df.withColumn("lang", df["text"]).limit(0)) == []
    assert langid.identify(df.limit(0), prototypes).count() == 0


UNLEARNED = [
    "Suomi on valtio Pohjois-Euroopassa Itämeren rannalla. Se rajoittuu idässä Venäjään, pohjoisessa Norjaan ja lännessä "
    "Ruotsiin. Suomessa on noin viisi ja puoli miljoonaa asukasta, joista suurin osa asuu maan eteläosissa.",
    "Россия — государство в Восточной Европе и Северной Азии. Территория России в её конституционных границах составляет "
    "более семнадцати миллионов квадратных километров. Столица — Москва. Государственный язык на всей территории — русский."]


def test_unlearned_languages_and_junk_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = docs.where(~langid.held_out())
    prototypes = langid.train(learned)
    least = langid.floors(learned, prototypes)
    assert set(least) == {lang for lang, _ in prototypes} and min(least.values()) > 0.01
    rnd = random.Random(6)
    junk = list(UNLEARNED)
    for low, high in ((0x430, 0x44F), (0x4E00, 0x9FA5), (0x627, 0x64A), (0x3B1, 0x3C9), (97, 122)):
        for words in (150, 30, 12):  # the last have less than 200 characters
            junk += [" ".join("".join(chr(rnd.randint(low, high)) for _ in range(rnd.randint(2, 9))) for _ in range(words))
                     for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string")
    kept = [r.text for r in langid.accepted(df, prototypes, least=least).collect()]
    assert not set(kept) & set(UNLEARNED) and len(kept) <= 0.02 * len(junk), [t[:40] for t in kept]
    ours = docs.where(langid.held_out() & (F.length("text") >= 200))
    assert langid.accepted(ours, prototypes, least=least).count() >= 0.99 * ours.count()
    short = ours.withColumn("text", F.substring("text", 1, 60))
    assert langid.accepted(short, prototypes, least=least).count() >= 0.98 * ours.count()


def test_ngrams_bind_letters_by_place():
    label, gram, count = langid._ngrams(["ab, a"], np.zeros(1, int))
    assert count.sum() == 4  # " ab", "ab ", "b a", " a "
    one = langid.bundle(gram[:1], np.ones(1))
    assert set(np.unique(one)) <= {-1.0, 1.0}
    assert abs(langid.bundle(np.array([5]), np.ones(1)) @ langid.bundle(np.array([6]), np.ones(1))) < 0.3 * langid.DIMS


def gear_brute(data):
    g, h, out = chunkprints._gear().tolist(), 0, []
    for b in data:
        h = ((h << 1) + g[b]) & 0xFFFFFFFF
        out.append(h)
    return out


def test_gear_hash_and_boundaries_against_loop():
    rnd = random.Random(3)
    for n in (0, 1, 16, 17, 40, 300, 5000):
        data = bytes(rnd.randrange(97, 123) for _ in range(n))
        h = gear_brute(data)
        assert chunkprints.gear_hashes(np.frombuffer(data, np.uint8)).tolist() == h
        ends, at = [], 0
        while at < n:
            size = 0
            while at + size < n:
                size += 1
                bits = chunkprints.HARD if size <= chunkprints.NORMAL else chunkprints.EASY
                last = h[at + size - 1] >> 32 - bits == 0 and size >= chunkprints.LEAST
                easy_at_normal = size == chunkprints.NORMAL and h[at + size - 1] >> 32 - chunkprints.EASY == 0
                if last or easy_at_normal or size == chunkprints.MOST:
                    break
            at += size
            ends.append(at)
        got = chunkprints.boundaries(data)
        assert got[-1:] == ([n] if n else []) and all(b - a <= chunkprints.MOST for a, b in zip([0] + got, got))
        assert got == ends or n - (ends[-2] if len(ends) > 1 else 0) <= chunkprints.LEAST


def test_fingerprints_resist_shifts():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    text = " ".join(word() for _ in range(1500))
    own = chunkprints.chunk_set(text)
    assert chunkprints.containment(own, chunkprints.chunk_set("inserted " + text)) > 0.95
    assert chunkprints.containment(own, chunkprints.chunk_set(text[:5000] + " more words here " + text[5000:])) > 0.95
    assert chunkprints.containment(own, chunkprints.chunk_set(" ".join(word() for _ in range(1500)))) < 0.05
    assert (chunkprints.from_string(chunkprints.to_string(own)) == own).all()


def test_following_document_against_loop(spark):
    rnd = random.Random(5)
    rows = [(i * 7 % 401 - 20, "".join(rnd.choice("abé \n") for _ in range(rnd.randint(0, 200))), "x") for i in range(300)]
    rows += [(None, "no id", "x"), (9, None, "x"), (9, None, "x"), (12, "long text " * 9000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    slim = df.select("doc_id", "text").fillna("", ["text"])
    halos = chunkprints.with_following(slim, rows_per_range=40)
    assert halos.where("halo = 1").count() == halos.select("range").distinct().count() > 3
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (d, t) in enumerate(order):
        changed = chunkprints.edited(t, order[(k + 1) % len(order)][1])
        e, own = chunkprints.chunk_set(changed), chunkprints.chunk_set(t)
        want.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), chunkprints.to_string(own), chunkprints.to_string(e),
                     chunkprints.containment(own, e), chunkprints.containment(own, chunkprints.chunk_set(order[(k + 1) % len(order)][1]))))
    got = [tuple(r) for r in chunkprints.compare_following(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert chunkprints.compare_following(df.limit(0)).count() == 0
    one = chunkprints.compare_following(df.where("doc_id IS NULL")).first()
    assert one.near_next == 1.0
    assert {r.fingerprint for r in chunkprints.fingerprint(df).where("doc_id = 9").collect()} >= {""}


HEAD = "<html><head><title>no</title><script>var x='<p>no</p>';</script></head><body>"


def page(main, extra=""):
    return (HEAD + "<nav><a href='/'>Home</a></nav><div class='cookie-notice'>We use cookies on this site, agree please</div>"
            + main + extra + "<footer>&copy; site</footer></body></html>")


def test_extraction_of_templates(spark):
    long = "This paragraph is the text of the article and it is long enough to be found. "
    div = "<div class='col post-{0}'><h2>Title &amp; {0}</h2><p>" + long + "<p>Second&nbsp;one<br>after <b>bold</b></div>"
    rows = [(i, "http://a.org/x", page(div.format(i), f"<div class='sidebar'>{long * 9}</div><section id='comments'><p>Nice post {long * 4}</p></section>")) for i in range(6)]
    rows += [(90, "https://B.org:80/y", page("<article><header><h1>Head</h1></header><p>" + long + "</p><aside>" + long * 5 + "</aside><ul><li>one<li>two</ul></article>")),
             (91, "https://b.org/z", page("<article><p>Short.</p></article>", "<form>Your name<input></form>"))]
    rows += [(92, None, None), (93, "http://a.org/", ""), (94, "bad url", "plain <b>text</b> &lt;only"), (94, "bad url", "plain <b>text</b> &lt;only"),
             (None, "http://c.org", page("<main><p>" + "word " * 50000 + "</p><p>end</p></main>")), (95, "http://a.org/cut", page(div.format(7))[:-150] + "<p cla")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").repartition(4)
    got = {}
    for r in hostpaths.extract_text(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(6):
        assert got[i] == [f"Title & {i}\n{long.strip()}\nSecond one after bold"]
    assert got[90] == [f"Head\n{long.strip()}\none\ntwo"]
    assert got[91] == ["Short."]
    assert got[92] == [""] and got[93] == [""]
    assert got[94] == ["plain text <only"] * 2
    assert got[None] == ["word " * 49999 + "word\nend"]
    assert got[95][0].startswith("Title & 7\nThis paragraph")
    assert hostpaths.extract_text(df.limit(0)).count() == 0


def test_winning_path_needs_the_host(spark):
    """Pages whose own best container is another one follow their host."""
    long = "Words of the article that every page of this host has in the same place. "
    usual = page("<div class='story'><p>" + long + "</p><p>" + long + "</p></div>")
    odd = page("<div class='story'><p>" + long + "</p><p>" + long + "</p></div>", "<div class='q'><p>" + long * 2 + "</p><p>" + long + "</p></div>")
    df = spark.createDataFrame([(i, "http://h.org/", usual) for i in range(9)] + [(9, "http://h.org/", odd)], "page_id long, url string, html string")
    paths = {r.host: r.paths for r in hostpaths.host_paths(df.select(hostpaths.host_of(df["url"]).alias("host"), "html")).collect()}
    assert paths["h.org"][0] == ">html>body>div.story"
    assert len({r.text for r in hostpaths.extract_text(df).collect()}) == 1


def test_title_and_lead_beside_the_body_stay(spark):
    """Title and lead outside the body container, and an article over two containers."""
    long = "Words of the article that every page of this host has in the same place. "
    body = "<div class='body'>" + f"<p>{long}</p>" * 8 + "</div>"
    head = "<h1>Title</h1><p class='lead'>" + "The lead of the article. " * 3 + "</p>"
    two = "<div class='part'>" + f"<p>{long}</p>" * 6 + "</div><div class='more'>" + f"<p>{long}</p>" * 3 + "</div>"
    lead, text = ("The lead of the article. " * 3).strip(), long.strip()
    whole = "\n".join(["Title", lead] + [text] * 8)
    plain = "\n".join([text] * 8)
    cases = {"a": ("<article>" + head + body + "</article>", whole), "d": ("<div class='post'>" + head + body + "</div>", whole),
             "t": ("<article>" + two + "</article>", "\n".join([text] * 9)), "u": ("<div class='x'>" + two + "</div>", "\n".join([text] * 9))}
    rows = [(i, f"http://{h}.org/", page(m)) for h, (m, _) in cases.items() for i in range(5)]
    rows += [(i, f"http://mixed{h}.org/", page(f"<{t}>" + body + f"</{t}>")) for h, t in (("1", "article"), ("2", "div")) for i in range(9)]
    rows += [(99, f"http://mixed{h}.org/", page(f"<{t}>" + head + body + f"</{t}>")) for h, t in (("1", "article"), ("2", "div"))]
    got = hostpaths.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        host = r.url[7:-5]
        assert r.text == (cases[host][1] if host in cases else whole if r.page_id == 99 else plain), (host, r.page_id)


def test_names_only_vote(spark):
    """Wrappers whose names hold a listed word keep the article; named boilerplate
    goes by its links, its words or its host's pages."""
    long = "Words of the article that this page alone has, number {0}, in its own place. "
    text = "<p>" + long + "</p><p>" + long * 2 + "</p>"
    wrappers = ["<div class='content has-sidebar'>{}</div>", "<div class='elementor-widget-container'>{}</div>",
                "<div id='page' class='site menu-open'>{}</div>", "<section class='social-policy'>{}</section>",
                "<div class='wrap has-sidebar'><article>{}</article></div>", "<div class='sidebar'><article>{}</article></div>",
                "<div class='widget'>{}</div>"]
    rows = [(k, f"http://w{k}.org/", page(w.format(text.format(k)))) for k, w in enumerate(wrappers)]
    whole = lambda k: long.format(k).strip() + "\n" + (long * 2).format(k).strip()
    want = {k: whole(k) for k in range(len(wrappers))}
    parts = ("<blockquote class='social-quote'>A quote of {0}.</blockquote>", "<div class='share-box'><a href='/'>Share this</a> now</div>",
             "<div class='promo-box'>Buy our book, 3 left.</div>", "<div class='comment-list'><p>" + long * 3 + "</p></div>", "<div class='ad'>Buy {0}</div>")
    for k in range(100, 106):
        word = "abcdef"[k - 100]
        rows.append((k, "http://host.org/x", page("<article>" + text.format(k) + "".join(parts).format(word) + "</article>")))
        want[k] = whole(k) + f"\nA quote of {word}."
    rows += [rows[-1]] * 9  # copies of one page do not make its quote boilerplate
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, paths string")
    got = [(r.page_id, r.text) for r in hostpaths.extract_text(df.repartition(3)).collect()]
    assert len(got) == len(rows) and dict(got) == want
