import pytest

from tidelog.llm import lines

SCHEMA = "doc_id long, text string, source string, line string, kept string, n_lines int"


def run(spark, rows, min_sites):
    df = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in lines.drop_lines(df, min_sites).collect()), key=str)


def brute(rows, min_sites):
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                sites.setdefault(line.strip(" "), set()).add(site or "")
    out = []
    for i, text, _ in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(sites.get(x.strip(" "), ())) < min_sites]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_sites", [2, 10])
def test_against_brute_force(spark, min_sites):
    rows = [(i, "\n".join([f"line {i % 7}", "everywhere ", "", f"own {i}", " everywhere"]), f"s{(i * i) % 23}") for i in range(120)]
    rows += [(None, None, None), (None, "everywhere", None), (5, "everywhere\nother", ""), (7, "", "s1"), (7, "", "s1"),
             (900, "everywhere\n" * 30_000 + "end", "s2")]
    assert run(spark, rows, min_sites) == brute(rows, min_sites)


def test_estimates_far_from_the_threshold_decide_alone(spark):
    low, high = lines.doubt_band(1000)
    rows = [(i, "wide\nnear" if i < 1010 else "wide", f"site {i}") for i in range(3000)]
    assert high < 2700 and low > 500
    assert run(spark, rows, 1000) == brute(rows, 1000)
    assert run(spark, rows, 1011)[0][2] == 1


def test_empty_table(spark):
    assert run(spark, [], 2) == []
