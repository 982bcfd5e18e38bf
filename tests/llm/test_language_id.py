import numpy as np
import pytest

from helpers_llm import docs_frame
from loadcast.llm import language_id as L

WORDS = {"en": "the house and with that was they have from this which".split(),
         "de": "das haus und mit dass war sie haben von diese welche".split(),
         "fr": "la maison et avec que etait ils avoir cette lequel".split()}
PAGES = "page_id bigint, url string, html string"


def text(r, lang, n):
    return " ".join(r.choice(WORDS[lang], n))


@pytest.fixture(scope="module")
def docs(spark):
    r = np.random.default_rng(1)
    rows = [(i, text(r, x, 40), x, "src0") for i, x in enumerate(list(WORDS) * 30)]
    return docs_frame(spark, rows + [(None, "x", "en", "src0"), (500, None, "de", "src0"), (501, "x", None, "src0")])


def page(lang, body, declared=None):
    attr = f' lang="{declared}"' if declared else ""
    return f"<!DOCTYPE html><html{attr}><head><title>t</title></head><body><script>var x='the';</script><p>{body}</p></body></html>"


def test_evidence_is_fused(spark, docs):
    r = np.random.default_rng(2)
    rows = [(i, f"http://h{i % 3}.{'de' if i % 2 else 'com'}/p", page(x, text(r, x, 30), x if i % 5 else None))
            for i, x in enumerate(list(WORDS) * 40)]
    truth = {i: x for i, x in enumerate(list(WORDS) * 40)}
    rows += [(1000 + i, "http://mono.com/p", page("fr", text(r, "fr", 30), "fr")) for i in range(40)]
    rows += [(2000, "http://mono.com/q", page("", "", None)), (2001, "http://unseen.de/", ""), (2002, None, None),
             (2003, "http://x.com/", page("", "", "fr-CA")), (2004, "http://x.com/", page("de", text(r, "de", 60), "en")),
             (2005, "http://x.com/", page("", "", "zz")), (2006, "http://x.com/", page("de", text(r, "de", 30_000), "de"))]
    df = spark.createDataFrame(rows, PAGES).repartition(3).selectExpr("*", "1 AS lang", "2 AS host")
    got = {x.page_id: x for x in L.identify(df, docs).collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i].lang == x for i, x in truth.items()]) > 0.97
    assert got[2000].lang == "fr"  # nothing but the host speaks
    assert got[2001].lang == "de"  # nothing but the address suffix
    assert got[2003].lang == "fr"  # nothing but the markup
    assert got[2004].lang == "de"  # a long text outweighs the markup
    assert got[2006].lang == "de" and got[2002].lang in WORDS and 0 < got[2005].confidence <= 1


def test_visible_text():
    assert L.visible_text("<html><head><title>x</title></head><!-- a --><nav>n</nav><p>b &amp; c</p><style>s</style>").split() \
        == ["b", "&", "c"]


def test_degenerate_tables(spark, docs):
    pages = spark.createDataFrame([(1, "http://a.com/", page("en", "the house"))], PAGES)
    assert [r.lang for r in L.identify(pages, docs.limit(0)).collect()] == [None]
    assert L.identify(pages.limit(0), docs).count() == 0
