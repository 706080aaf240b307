"""Classifiers, page text, chat formatting, search and the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from tiermart.llm import chat, html, language, mtree, queries, sql, template, toxicity
from tiermart.llm.common import fold, table

SF_DIR = "/root/testdata/sf0.01"


# SQL


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), sql.ORACLES[name]) is None


# Language


@pytest.fixture(scope="module")
def languages(spark):
    docs = table(spark, SF_DIR, "documents")
    return language.fit(docs.filter(fold("doc_id", 4) != 2))


def test_held_out_languages(spark, languages):
    docs = table(spark, SF_DIR, "documents").filter((fold("doc_id", 4) == 2) & (F.length("text") > 20))
    found = language.identify(docs.select("doc_id", "text", "lang"), languages).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
    assert not found.rejected.any()
    assert found.score.between(0, 1).all()


def test_odd_texts_have_no_language(spark, languages):
    rows = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (3, "12 !?", "old"), (4, "the of and to the", "old"), (5, "中文字符 漢字 かな", "old")], "doc_id long, text string, score string")
    found = {r.doc_id: r for r in language.identify(rows, languages).collect()}
    assert [(found[i].lang_pred, found[i].score, found[i].rejected) for i in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert found[4].lang_pred == "en" and not found[4].rejected
    assert 0 <= found[5].score <= 1


def test_gibberish_and_unseen_languages_are_rejected(spark, languages):
    rng = random.Random(1)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    latin = "abcdefghijklmnopqrstuvwxyz"
    odd = [
        some(latin, 1500),
        " ".join(some(latin, rng.randrange(2, 9)) for _ in range(250)),
        some(latin + latin.upper() + "0123456789+/", 1200),
        " ".join(some("абвгдежзиклмнопрстуфхцчшыьэюя", 6) for _ in range(200)),
        "Suomen kieli kuuluu uralilaisiin kieliin ja sitä puhuu noin viisi miljoonaa ihmistä pääasiassa Suomessa, mutta myös muualla maailmassa.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    ]
    clean = ["the of and to the", "This is the house and it was there for the other.", "der die und das ist nicht", "les des est dans que pour", "los que de la en el"]
    _, _, rejected = languages.predict([*odd, *clean])
    assert rejected.tolist() == [True] * len(odd) + [False] * len(clean)
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    assert language.identify(docs, languages).filter("rejected").count() == 0


def test_no_labelled_rows(spark):
    rows = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(rows, language.fit(rows)).collect()] == ["und"]
    assert language.identify(rows.limit(0), language.fit(rows)).count() == 0


NATURAL = {
    "en": ["All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.", "The weather was cold this morning, so we stayed at home and read the newspaper until lunch.", "She opened the window and looked at the garden where the children were playing."],
    "de": ["Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.", "Heute Morgen war es kalt, deshalb sind wir zu Hause geblieben und haben bis zum Mittag Zeitung gelesen.", "Sie öffnete das Fenster und schaute in den Garten, in dem die Kinder spielten."],
    "fr": ["Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.", "Il faisait froid ce matin, alors nous sommes restés à la maison et nous avons lu le journal jusqu'au déjeuner.", "Elle ouvrit la fenêtre et regarda le jardin où jouaient les enfants."],
    "es": ["Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.", "Hacía frío esta mañana, así que nos quedamos en casa y leímos el periódico hasta la hora de comer.", "Ella abrió la ventana y miró el jardín donde jugaban los niños."],
}
UNSEEN = [
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
]


def test_natural_sentences_are_kept_and_other_languages_rejected(spark):
    model = language.fit(table(spark, "/root/testdata/sf0.1", "documents"))
    for lang, texts in NATURAL.items():
        found, _, rejected = model.predict(texts)
        assert found == [lang] * len(texts) and not rejected.any()
    assert model.predict(UNSEEN)[2].all()


# Toxicity


def toxic_corpus(spark):
    rng = random.Random(6)
    syllables = ["an", "er", "in", "th", "on", "re", "ti", "es"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for i in range(500):
        words = [word() for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(40), rng.choice(["blockhead", "dumbo", "fooly"]))
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxic_texts_are_found(spark):
    rows = toxic_corpus(spark)
    held_out = F.col("doc_id") % 5 == 0
    model = toxicity.fit(rows.filter(~held_out))
    found = toxicity.score(rows.filter(held_out), model).toPandas()
    assert (found.predicted == found.toxic).mean() > 0.97
    spoilt = model.words(["blockhead", "block-head", "bloxckhead", "b.l.o.c.k.h.e.a.d", "erinth"])
    assert spoilt[0] > 1 and spoilt[1] > 0 and spoilt[2] > 0 and spoilt[3] > spoilt[4] and spoilt[4] < 0


def test_odd_texts_are_not_toxic(spark):
    model = toxicity.fit(toxic_corpus(spark))
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "an er in " * 4000, "x"), (5, "a" * 5000, "x")], "doc_id long, text string, score string")
    found = toxicity.score(rows, model).collect()
    assert [r.predicted for r in found] == [0] * 5
    assert all(0 <= r.score < 0.7 for r in found)
    assert toxicity.score(rows.limit(0), model).count() == 0


def plain_subsequences(word):
    """Weight of each subsequence of a marked word, by gaps."""
    marked = chr(toxicity.EDGE) + word + chr(toxicity.EDGE)
    found = {}
    for gaps in toxicity.GAPS:
        steps = [0, *np.cumsum([g + 1 for g in gaps]).tolist()]
        for i in range(len(marked) - steps[-1]):
            key = "".join(marked[i + s] for s in steps)
            found.setdefault((gaps, key), 0)
            found[gaps, key] += 1
    grouped = {}
    for (gaps, key), n in found.items():
        grouped.setdefault(key, []).extend([toxicity.DECAY ** sum(gaps)] * n)
    return grouped


def plain_kernel(a, b):
    """Gap-weighted common subsequences, scaled by the weights of both words."""
    x, y = plain_subsequences(a), plain_subsequences(b)
    both = sum(sum(x[k]) * sum(y[k]) for k in x.keys() & y.keys())
    size = [sum(w * w for ws in z.values() for w in ws) ** 0.5 for z in (x, y)]
    return both / (size[0] * size[1])


def test_the_folded_machine_is_the_kernel_machine():
    marks = ["blockhead", "dumbo", "erinth", "anerin"]
    words = ["blockhead", "block-head", "bloxckhead", "dumbos", "other", "an", "xyzzy"]
    landmarks = toxicity.Landmarks(marks)
    plain = np.array([[plain_kernel(w, m) for m in marks] for w in words])
    assert np.allclose(landmarks.kernel(words), plain, atol=2e-3)
    # Any weights of the landmarks fold into one weight for each subsequence.
    alpha = np.array([0.5, -1.0, 2.0, 0.25])
    weights = np.zeros(toxicity.DIM, np.float32)
    weights[landmarks.places] = landmarks.rows[:-1] @ alpha
    model = toxicity.Model(weights, 0.125, (2.0, 2.0, 0.0))
    assert np.allclose(model.words(words), plain @ alpha + 0.125, atol=5e-3)


def test_held_out_labels_are_predicted(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.op2_toxicity(spark, sf_dir).filter("held_out").join(table(spark, sf_dir, "labels"), "doc_id").select("predicted", "toxic").toPandas()
    toxic = found[found.toxic == 1].predicted
    assert len(toxic) > 50 and toxic.mean() >= 0.85
    assert found[found.toxic == 0].predicted.mean() <= 0.01


def test_one_label_only(spark):
    rows = toxic_corpus(spark).filter("toxic = 0")
    assert toxicity.score(rows, toxicity.fit(rows)).filter("predicted = 1").count() == 0


# Page text

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href=/a>Home page</a></li></ul></nav><div class=\"ad\">Buy now</div>"
    "<article><h1>A &amp; B</h1><p>First   <b>bold</b>\n text.<p>Second &lt;x&gt;&nbsp;y.</p>"
    "<aside>Not this</aside><ul><li>One<li>Two</ul></article>"
    "<div class='comments'><p>Nice post</p></div><footer>&copy; me</footer>"
)


def test_page_text(spark):
    pages = spark.createDataFrame([(i, "u", PAGE, "old") for i in range(30)] + [(30, "u", None, "old"), (31, "u", "", "old"), (32, "u", "<nav>a</nav>", "old")], "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in html.extract(pages, html.fit(pages)).collect()}
    assert found[0] == "A & B\nFirst bold text.\nSecond <x> y.\nOne\nTwo"
    assert [found[i] for i in (30, 31, 32)] == ["", "", ""]


def test_pages_without_a_model(spark):
    model = html.fit(spark.createDataFrame([(1, "<p>x")], "page_id long, html string"))
    assert model.extract("<div><p>Some words in a row of words</p></div><nav>Menu</nav>") == "Some words in a row of words"


def test_only_the_hidden_attribute_hides():
    model = html.Model({}, {})
    text = "Some words in a row of words"
    for attributes in ('style="overflow:hidden"', "style='overflow: hidden'", 'title="a hidden gem"', "href=/hidden/x", 'data-id="menu" data-role="dialog"', 'class="hidden"', "aria-hidden=false"):
        assert model.extract(f"<div {attributes}><p>{text}</p></div>") == text
    for attributes in ("hidden", 'hidden=""', 'class="x" HIDDEN', 'hidden="until-found" id=a', 'title="a>b" hidden'):
        assert model.extract(f"<div {attributes}><p>Not this</p></div><p>{text}</p>") == text


def test_names_do_not_drop_the_article(spark):
    text = "Some words in a row of words"
    page = '<html class="menu-closed"><body class="{0}"><div id="{1}"><{2} class="post ad-free">' + f"<p>{text}</p>" + '<div class="ad">Buy</div></{2}></div><div class="{3}"><{2}><p>Nice</p></{2}></div></body></html>'
    pages = [page.format(*x) for x in (("single no-sidebar", "x", "article", "comments"), ("has-sidebar menu", "widget", "article", "y"), ("comments-open", "x", "main", "comments"))]
    model = html.fit(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))
    for m in (model, html.Model({}, {})):
        assert all(text in m.extract(p) and "Buy" not in m.extract(p) for p in pages)
        assert m.extract(pages[0]) == m.extract(pages[2]) == text
        assert m.extract('<body><div class="has-sidebar"><p>' + text + "</p></div></body>") == text


def test_parts_of_names_are_learned(spark):
    text, foot = "Some words in a row of words", "All the rights are reserved by us and by others too"
    page = f'<body><article><p>{text}</p></article><div class="site-footer"><p>{foot}</p></div></body>'
    model = html.fit(spark.createDataFrame([(i, page) for i in range(20)], "page_id long, html string"))
    assert model.words["body.footer/p"] < 0
    assert model.extract(page) == text


def test_broken_pages_do_no_harm():
    model = html.Model({}, {})
    for page in ("<p", "<", "</", "<!--", "<script>", "</p></p>text more", "<a b='c", "&#x0;&bogus;", "<p>" * 3000 + "x"):
        assert isinstance(model.extract(page), str)


@pytest.mark.parametrize("mark", ["<font>x ", "<div>x ", "<a ", "<a b='c \" ", "<script ", "<a<a", "<div class=ad>x ", "</b><i>", "<article>x ", "<li><td>"])
def test_time_grows_with_a_page_not_its_square(mark):
    import time

    def seconds(size):
        begin = time.perf_counter()
        html.parts(mark * (size // len(mark)))
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(1_000_000) < 20


def test_tags_are_those_of_a_plain_reading():
    """Against a pattern that looks at every tag to the end of the page."""
    import random
    import re

    plain = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)""", re.S)
    rng = random.Random(4)
    marks = ["<p>", "</p>", "<a ", 'b="', "'", '"', ">", "<!--", "-->", "<!x", "</ ", "<", "/", " x ", "<br/>", "<i a=1>"]
    for _ in range(3000):
        page = "".join(rng.choice(marks) for _ in range(rng.randrange(15)))
        tags, scan, found = html._Tags(page), 0, []
        while tag := tags.find(scan):
            found.append(tag)
            scan = tag[1]
        assert found == [(m.start(), m.end(), (m[2] or "").lower(), bool(m[1]), m[3] or "") for m in plain.finditer(page)]


def test_pages_equal_their_articles(spark):
    found = queries.op4_html_text(spark, SF_DIR).toPandas()
    pages = table(spark, SF_DIR, "pages").toPandas().set_index("page_id").html
    import html as plain
    import re

    assert len(found) == len(pages)
    for page_id, text in zip(found.page_id, found.text, strict=True):
        article = re.search("<article>(.*)</article>", pages[page_id], re.S)[1]
        blocks = (" ".join(plain.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)[^>]*>", article))
        assert text == "\n".join(b for b in blocks if b)


# Chat


def test_templates_are_folded_and_sandboxed():
    filters = {"up": str.upper}
    tree = template.fold(template.parse("a{{ 'b' | up }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}", filters), filters)
    assert tree == [template.Write(template.Const("aBc"))]
    for bad in ("{% for x %}", "{{ x. }}", "{{ x | open }}", "{% endif %}", "{% if x %}", "{{ f() }}", "{% import os %}"):
        with pytest.raises(template.TemplateError):
            template.parse(bad, filters)
    sink = template.Sink()
    template.compile_template("{% for m in messages %}{{ m.__class__ }}{{ loop.index }}{% endfor %}", filters)([{"a": 1}], sink)
    assert sink.drain()[0] == "1"


def rendered(source, messages=()):
    sink = template.Sink()
    template.compile_template(source, {"up": str.upper})(iter(messages), sink)
    return sink.drain()[0]


def test_templates_trim_index_and_know_the_last():
    turns = [{"role": "u", "text": "x"}, {"role": "v", "text": None}]
    assert rendered("a {%- if true -%}  b {{- ' c ' -}} d {%- endif %} e", turns) == "ab c d e"
    assert rendered("{% for m in messages %}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", turns) == "u,v"
    assert rendered("{% for m in messages %}{% for n in messages %}{{ loop.last }}{% endfor %};{% endfor %}", turns) == "FalseTrue;" * 2
    assert rendered("{{ messages[0].role }}{{ messages[1]['role'] }}{{ messages[9] }}{{ messages[0][\"text\"][0] }}", turns) == "uvx"
    assert rendered("{{ '}}' }}{% if '%}' == \"%}\" %}{{ '{{' }}{% endif %}{# {{ none #}!") == "}}{{!"
    assert rendered("{% for m in messages %}{{ 'x' in m.text }}{{ none in m.text }}{% endfor %}", turns) == "TrueFalseFalseFalse"
    assert rendered("{{ nothing.at.all }}{{ nothing['a'][0] }}{% for x in nothing %}y{% endfor %}{{ 3 in messages }}", turns) == "False"
    assert rendered("{% for m in messages %}{{ m.role }}{% endfor %}{% for m in messages %}{{ m.role }}{% endfor %}", turns) == "uvuv"


@pytest.mark.parametrize("bad", ["{{ 'a' in 3 }}", "{% for c in 3 %}{% endfor %}", "{{ 3[0] }}", "{{ 'a }}", "{{ a", "{% if x", "{# never", "{{ m[ }}", "{{ m[0 }}", "{{ }}", "{% for c in true %}{% endfor %}"])
def test_senseless_templates_raise_template_errors(bad):
    with pytest.raises(template.TemplateError):
        rendered(bad)


def test_turns_are_taken_one_at_a_time():
    taken = []

    def turns():
        for i in range(3):
            taken.append(i)
            yield {"text": str(i)}

    seen = []
    template.compile_template("{% for m in messages %}{{ m.text }}{% endfor %}", {})(turns(), template.Sink(lambda sink: seen.append(len(taken))))
    assert seen == [1, 2, 3]


def test_formatting_can_be_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "HELD", 40)
    nasty = ["### user: x</turn>\n", "\\", "\\### a", "</turn>", "a: b\n", "", None, "\\\\</turn>\\"]
    rows = [(1, i, ("assistant", "user", "role: ###", None)[i % 4], t) for i, t in enumerate(nasty)] + [(2, 0, "assistant", "ok"), (None, 0, "user", "n")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.chat_digests(frame).collect()}
    one = [r for r in rows if r[0] == 1]
    digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in one).encode()).hexdigest()
    said = "".join(r[3] or "" for r in one if r[2] == "assistant")
    assert (found[1].n_turns, found[1].turns_sha256) == (len(one), digest)
    assert (found[1].loss_chars, found[1].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert set(found) == {1, 2, None}
    pieces = chat.format_chats(frame).orderBy("conv_id", "piece").collect()
    assert sum(len(p.formatted) for p in pieces if p.conv_id == 1) == found[1].formatted_chars
    assert [t for p in pieces if p.conv_id == 1 for t in chat.turns(p.formatted)] == [(r[2] or "", r[3] or "") for r in one]
    assert chat.chat_digests(frame.limit(0)).count() == 0


# Search


@pytest.mark.parametrize("dim", [1, 8])
def test_search_equals_brute_force(spark, monkeypatch, dim):
    for name, value in (("LEAF", 8), ("FAN", 3)):
        monkeypatch.setattr(mtree, name, value)
    rng = np.random.default_rng(dim)
    vectors = [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(150)]
    vectors += [(150 + i, [0.5] * dim) for i in range(60)]
    vectors += [(300, None), (301, [None] * dim), (302, [float("nan")] * dim), (303, [float("inf")] * dim), (304, []), (305, [1.0] * (dim + 1))]
    rows = mtree.whole_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    pages, tops, top = mtree.index(rows, shard=64)
    found = mtree.search(pages, tops, top, rows.filter("vec_id % 20 = 0"), k=7, block=3).collect()
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors if i < 300}
    expected = []
    for q in (i for i in whole if i % 20 == 0):
        best = sorted(((int(whole[q] @ whole[i]), i) for i in whole if i != q), key=lambda s: (-s[0], s[1]))[:7]
        expected += [(q, n + 1, i, s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_search_without_vectors(spark):
    rows = mtree.whole_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>"))
    assert mtree.search(*mtree.index(rows), rows).count() == 0


# Pipeline


def test_clustered_vectors_leave_most_shards_unasked(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 300
    vectors = (centres[np.arange(3000) % 12] + rng.normal(size=(3000, 16)) * 3).astype(int)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<long>")
    pages, tops, top = mtree.index(rows, shard=250)
    asked = []
    left = mtree._left_to_ask

    def counted(bounds, ends):
        found = left(bounds, ends)
        asked.append((bounds.count(), found.count()))
        return found

    monkeypatch.setattr(mtree, "_left_to_ask", counted)
    found = mtree.search(pages, tops, top, rows.filter("vec_id % 30 = 0"), k=5).collect()
    scores = vectors @ vectors.T
    for q in range(0, 3000, 30):
        best = sorted((-int(scores[q, i]), i) for i in range(3000) if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == best
    assert asked[0][1] < 0.4 * asked[0][0]


def test_wide_vectors_need_little_memory():
    import tracemalloc

    points = np.random.default_rng(4).normal(size=(4096, 768))
    tracemalloc.start()
    assert sum(len(p[5]) for p in mtree._build(points) if p[5] is not None) == 4096
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_pipeline_stages_equal_plain_versions(spark):
    docs = table(spark, SF_DIR, "documents")
    known = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert known.columns == docs.columns
    assert known.count() == docs.count()
    clean = corpus_pipeline.not_toxic(spark, known, SF_DIR).persist()
    assert clean.columns == docs.columns
    texts = {}
    for r in clean.collect():
        texts[r.text] = max(r.doc_id, texts.get(r.text, -1))
    single = corpus_pipeline.exact_copies(spark, clean, SF_DIR)
    assert sorted(r.doc_id for r in single.collect()) == sorted(texts.values())
    rows = [(i, t) for t, i in texts.items()]
    apart = corpus_pipeline.near_copies(spark, single, SF_DIR)
    from test_documents import brute_components

    expected, _ = brute_components(rows, 5)
    kept = sorted(r.doc_id for r in apart.collect())
    assert kept == sorted(i for i, c in expected.items() if i == c)
    packed = corpus_pipeline.packed(spark, apart, SF_DIR)
    assert sorted(r.doc_id for r in packed.filter("piece = 0").select("doc_id").collect()) == kept


def test_fits_hold_few_copies_on_the_driver():
    """Peak memory of the two largest steps that run on the driver."""
    import tracemalloc

    counts = np.random.default_rng(1).integers(0, 9, (2000, language.DIM)).astype(np.float32)
    idf = np.linspace(1, 2, language.DIM, dtype=np.float32)
    plain = np.sqrt(counts) * idf
    plain /= np.maximum(np.linalg.norm(plain, axis=1, keepdims=True), 1e-12)
    words = [f"word{i:04d}ending{i * 7919 % 997}" for i in range(1200)]
    marks = toxicity.Landmarks(words[:360])
    tracemalloc.start()
    try:
        vectors = language._weighted(counts, idf)
        assert tracemalloc.get_traced_memory()[1] < counts.nbytes
        tracemalloc.reset_peak()
        kernel = marks.kernel(words)
        assert tracemalloc.get_traced_memory()[1] < 4 * kernel.nbytes + 20e6
    finally:
        tracemalloc.stop()
    assert (vectors == plain).all()
    assert np.allclose(kernel[:360], marks.gram(), atol=1e-4)
