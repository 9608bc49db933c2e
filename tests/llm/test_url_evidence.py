"""Evidence of the URL filter that reaches pages without a rule."""

from cases import TESTDATA
from pyspark.sql import functions as F

from culvert.llm import queries, urls


def test_labels_reach_the_same_shape_on_other_hosts(spark):
    rows = [(f"https://{host}/win/{i}", host) for host in ("a.net", "b.org", "c.com") for i in range(40)]
    rows += [(f"https://b.org/about/{i}", "b.org") for i in range(40)]
    rows += [(f"https://b.org/help/{i}", "b.org") for i in range(40)]
    pages = spark.createDataFrame(rows, "url string, of string")
    rules = [urls.Rule("block", "a.net/win/"), urls.Rule("allow", "c.com/win/"), urls.Rule("allow", "b.org/help/")]
    verdicts = lambda rules: {
        (r.host, r.path.split("/")[1]): r.verdict for r in urls.judge(pages, rules).collect()
    }
    # All that is known of the shape is bad; elsewhere a host keeps its own share.
    found = verdicts([rules[0], rules[2]])
    assert found["b.org", "win"] == found["c.com", "win"] == "block"
    assert found["b.org", "about"] == "allow"
    # Hosts that disagree carry no verdict, and a host's own labels outweigh the others'.
    assert verdicts(rules)["b.org", "win"] == "allow"
    own = [rules[0], urls.Rule("allow", "b.org/win/1"), urls.Rule("allow", "b.org/win/2")]
    assert verdicts(own)["b.org", "win"] == "allow"


def test_one_template_has_one_purity(spark):
    found = queries.op5_url_templates(spark, f"{TESTDATA}/sf0.01")
    several = found.groupBy("host", "template").agg(F.max("purity") - F.min("purity")).toDF("h", "t", "d")
    assert several.filter("d > 1e-9").count() == 0


def test_the_method_blocks_pages_without_a_rule(spark):
    rows = queries.op5_url_templates(spark, f"{TESTDATA}/sf0.1").filter("rule IS NULL").collect()
    blocked = [r for r in rows if r.verdict == "block"]
    # Of the shapes, only those under /es/ are bad wherever a rule decides.
    assert blocked and all(r.path.startswith("/es/") for r in blocked)
    print(len(blocked), "of", len(rows))
