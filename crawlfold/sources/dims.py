"""Dimensions of the directory: districts, cuisines and areas.

Districts and cuisines are short fixed lists. The area list is a parameter: a table of
(district, area, area_code) that the user supplies for the city at hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlfold.schemas import AREAS

# District name -> district code.
DISTRICTS = {
    "静安区": "r3", "长宁区": "r4", "徐汇区": "r2", "杨浦区": "r10",
    "黄浦区": "r6", "虹口区": "r9", "普陀区": "r7", "闵行区": "r12",
    "宝山区": "r13", "浦东新区": "r5", "松江区": "r5937", "嘉定区": "r5938",
    "青浦区": "r5939", "金山区": "r8847", "奉贤区": "r8846", "崇明区": "c3580",
}

# Districts of level 2 and 3; all others are level 1.
LEVEL_2 = ("松江区", "嘉定区", "青浦区", "金山区", "奉贤区")
LEVEL_3 = ("崇明区",)

# Cuisine name -> cuisine code.
CUISINES = {
    "本帮江浙菜": "g101", "日本菜": "g113", "小吃快餐": "g112", "面包甜点": "g117",
    "火锅": "g110", "西餐": "g116", "自助餐": "g111", "粤菜": "g103",
    "韩国料理": "g114", "小龙虾": "g219", "烧烤": "g508", "下午茶": "g34014",
    "川菜": "g102", "其他美食": "g118", "东南亚菜": "g115", "面馆": "g215",
    "海鲜": "g251", "素菜": "g109", "人气餐厅": "g34032", "湘菜": "g104",
    "新疆菜": "g3243", "东北菜": "g106", "早茶": "g34055", "Brunch": "g34015",
    "云南菜": "g248", "蟹宴": "g203", "烤鱼": "g4473", "台湾菜": "g107",
    "西北菜": "g26481", "农家菜": "g25474", "北京菜": "g311", "贵州菜": "g105",
    "江西菜": "g247", "水果生鲜": "g2714", "家常菜": "g1783", "食品保健": "g33759",
    "饮品店": "g34236",
}


def level_of(district: Column) -> Column:
    """Crawl level of a district."""
    return F.when(district.isin(*LEVEL_3), 3).when(district.isin(*LEVEL_2), 2).otherwise(1)


def with_level(areas: DataFrame) -> DataFrame:
    return areas.withColumn("level", level_of(F.col("district")))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Area table from CSV files with the columns district, area, area_code."""
    return with_level(spark.read.csv(path, header=True, schema=AREAS))


def districts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DISTRICTS.items()), "district string, code string")


def cuisines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CUISINES.items()), "cuisine string, code string")
