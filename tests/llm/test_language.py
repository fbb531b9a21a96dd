import math
import time

from tabulae.llm import language as g

TEXTS = {"en": "the house and the garden were with this that which they would have there when from been",
         "de": "das haus und der garten waren mit dieser welche sie haben nicht eine auch nach werden",
         "fr": "la maison et le jardin avec cette que nous avons pour dans une est les des elle sont"}


def sample(spark):
    rows = [(i * 3 + k, lang, " ".join(w for j, w in enumerate(t.split() * 4) if (j + i) % 3)) for i in range(20)
            for k, (lang, t) in enumerate(TEXTS.items())]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_reading_equals_trigram_by_trigram(spark):
    model = g.fit(sample(spark))
    assert model.languages == ["de", "en", "fr"]
    reader = g.Reader(model)
    text = "Das HAUS and xqzt! the des"
    sums, n = [0.0] * 3, 0
    for word in "das haus and xqzt the des".split():
        marked = f" {word} "
        for i in range(len(word)):
            row = model.logs[model.trigrams.get(marked[i:i + 3], len(model.logs) - 1)]
            sums, n = [a + b for a, b in zip(sums, row)], n + 1
    weight = 1 / (1 + n / g.LEVEL_OFF)
    got, count = reader.read(text)
    assert count == n and all(math.isclose(a, b) for a, b in zip(got, [*[s * weight for s in sums], n * g.UNKNOWN_TRIGRAM * weight]))


def brute_prior(rows, classes, at, k):
    """Smoothed mix for row k by plain loops: host (without the row) towards domain towards suffix towards all."""
    size = len(classes)
    share = [g.UNKNOWN_SHARE if c == g.UNKNOWN else 1 / (size - 1) for c in classes]
    prior = [(sum(r["chance"][i] for r in rows) + g.SMOOTHING * share[i]) / (len(rows) + g.SMOOTHING) for i in range(size)]
    for level in ("suffix", "domain", "host"):
        group = [r for j, r in enumerate(rows) if r[level] == rows[k][level] and (level != "host" or j != k)]
        prior = [(sum(r["chance"][i] for r in group) + g.SMOOTHING * prior[i]) / (len(group) + g.SMOOTHING) for i in range(size)]
    return prior


def test_fusion_equals_brute_force(spark):
    model = g.fit(sample(spark))
    classes = [*model.languages, g.UNKNOWN]
    pages = []
    for i, (lang, text) in enumerate(list(TEXTS.items()) * 5):
        said = ["en", "de", None, "xx", lang][i % 5]
        tag = f' lang="{said}-X"' if said else ""
        pages.append((i, f"http://h{i % 4}.d{i % 2}.{'de' if i % 3 else 'org'}/{'fr/' if i % 7 == 0 else ''}x",
                      f"<html{tag}><script>the the</script><body><p>{' '.join(text.split()[:i % 6])}</p></body>"))
    pages += [(90, None, None), (91, "x", ""), (92, "http://H1.d1.de/", "<p>123</p>"), (92, "http://H1.d1.de/", "<p>123</p>")]
    rows = g.page_languages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()
    assert len(rows) == len(pages)
    reader, plain = g.Reader(model), []
    found = {(r.page_id, r.host): r for r in rows}
    for i, url, html in pages:
        r = next(r for r in rows if r.page_id == i)
        logs = reader.read(g.visible(html or ""))[0]
        top = max(logs)
        chance = [math.exp(x - top) for x in logs]
        host = r.host
        plain.append({"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "logs": logs,
                      "chance": [c / sum(chance) for c in chance], "declared": r.declared, "suggested": r.suggested, "id": i})
    values = [*classes, "other"]
    for k, row in enumerate(plain):
        prior = brute_prior(plain, classes, None, k)
        total = [a + math.log(max(p, 1e-9)) for a, p in zip(row["logs"], prior)]
        for column in ("declared", "suggested"):
            if row[column] is None:
                continue
            known = [r for r in plain if r[column] is not None]
            for i, c in enumerate(classes):
                hit = sum(r["chance"][i] for r in known if r[column] == row[column])
                guess = 0.5 if row[column] == c else 0.5 / len(values)
                total[i] += math.log((hit + g.SMOOTHING * guess) / (sum(r["chance"][i] for r in known) + g.SMOOTHING))
        p = [math.exp(x - max(total)) for x in total]
        p = [x / sum(p) for x in p]
        r = found[row["id"], row["host"]]
        assert r.lang == classes[p.index(max(p))] and abs(r.probability - max(p)) < 2e-6
    assert found[0, "h0.d0.org"].suggested == "fr" and found[3, "h3.d1.org"].declared == "other"


def test_documents_in_a_known_language_stay(spark, odd, none):
    model = g.fit(sample(spark))
    docs = sample(spark).selectExpr("doc_id", "text", "lang", "CAST(doc_id % 2 AS STRING) AS source", "1L AS n_chars")
    assert g.keep_known(docs, model).count() == docs.count()
    kept = g.keep_known(odd, model)
    assert kept.columns == odd.columns
    assert not {3, 4, 5, 9} & {r.doc_id for r in kept.collect()}  # no letters
    assert g.keep_known(none, model).count() == 0
    assert g.fit(none).languages == [] and g.keep_known(odd, g.fit(none)).count() == 0


def test_broken_markup_takes_linear_time():
    for mark in ("<script ", "<!-- ", "<meta ", "<html ", "<style>", "</script ", "<", "<meta content-language "):
        page = mark * (1_000_000 // len(mark))
        before = time.monotonic()
        text, said = g.visible(page), g.declared(page)
        assert time.monotonic() - before < 2 and said is None
        assert ">" in mark or text == page


def test_visible_text_and_declarations():
    page = "a<!-- <p> -->b<SCRIPT x>if (1<2) {}</script >c<style>p</STYLE><p title='x'>d</p><!-- e <b>f&amp;<script>g"
    assert g.visible(page).split() == ["a", "b", "c", "d", "f&", "g"]
    assert g.visible("1 < 2") == "1 < 2" and g.visible("") == ""
    assert g.declared('<HTML class=x LANG="De-AT"><body lang="fr">') == "de"
    assert g.declared('<html><meta http-equiv="Content-Language" content="fr-CA">') == "fr"
    assert g.declared('<meta content=\'nl\' http-equiv=content-language><BODY>') == "nl"
    assert g.declared('<html><BODY><html lang="de">') is None and g.declared("") is None


def test_a_rare_language_stays_a_class(spark):
    common = spark.range(20_000).selectExpr("id AS doc_id", "'en' AS lang", f"'{TEXTS['en']}' AS text")
    rare = spark.createDataFrame([(10**6 + i, "de", TEXTS["de"]) for i in range(2)], "doc_id long, lang string, text string")
    model = g.fit(common.union(rare), rows=400)
    assert model.languages == ["de", "en"]
    logs, n = g.Reader(model).read(TEXTS["de"])
    assert n and max(logs) == logs[0]
