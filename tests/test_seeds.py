"""Dimensions, levels and seed URLs."""

import pytest

from crawlfold.operators import seeds
from crawlfold.params import SITE
from crawlfold.plans import rounds
from crawlfold.sources import dims

# Two areas of level 1, two of level 2, one of level 3; one name occurs twice.
AREAS = [("浦东新区", "高行", "r24141"), ("静安区", "高行", "r88867"), ("松江区", "佘山", "r5942"),
         ("嘉定区", "安亭", "r5945"), ("崇明区", "堡镇", "r64598")]


@pytest.fixture
def areas(spark, tmp_path):
    lines = ["district,area,area_code"] + [",".join(a) for a in AREAS]
    (tmp_path / "areas.csv").write_text("\n".join(lines), encoding="utf-8")
    return dims.read_areas(spark, str(tmp_path))


def codes(df):
    return sorted(r["area_code"] for r in df.collect())


def test_fixed_lists():
    assert (len(dims.DISTRICTS), len(dims.CUISINES)) == (16, 37)
    assert len(set(dims.CUISINES.values())) == 37
    assert set(dims.LEVEL_2) | set(dims.LEVEL_3) < set(dims.DISTRICTS)


def test_levels(areas):
    assert {r["area_code"]: r["level"] for r in areas.collect()} == {
        "r24141": 1, "r88867": 1, "r5942": 2, "r5945": 2, "r64598": 3}
    assert codes(seeds.areas_of_level(areas, 2)) == ["r5942", "r5945"]
    assert codes(seeds.areas_up_to(areas, 2)) == ["r24141", "r5942", "r5945", "r88867"]


@pytest.mark.parametrize("level,count", [(1, 2), (2, 2 * 2 + 2), (3, 2 * 3 + 2 * 2 + 1)])
def test_repeated_levels(areas, level, count):
    assert seeds.areas_up_to(areas, level, repeat=True).count() == count


def test_shipped_level_is_exact(areas):
    urls = [r["url"] for r in rounds.listing_requests(areas, 3).collect()]
    assert len(urls) == 37 and len(set(urls)) == 37
    assert SITE.seed_base + "r64598g101" in urls
    assert rounds.listing_requests(areas, 3, inclusive=True).count() == 5 * 37


def test_seed_urls_need_no_join_and_no_shuffle(areas):
    plan = seeds.seed_urls(areas)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Cartesian" not in plan


def test_decoding_keys_on_the_code(spark, areas):
    pages = seeds.seed_urls(areas).select("url")
    rows = {(r["district"], r["area"], r["cuisine"]) for r in seeds.decode_seed_urls(pages, areas).collect()}
    assert rows == {(d, a, c) for d, a, _ in AREAS for c in dims.CUISINES}


def test_search_url(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a b&c",)], "name string")
    row = df.select(seeds.search_url(F.col("name")).alias("e"), seeds.search_url(F.col("name"), False).alias("r")).first()
    assert row["e"].endswith("a+b%26c") and row["r"].endswith("a b&c")
