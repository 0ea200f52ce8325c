"""Posting-shaped views over the star-schema tables.

Each row is derived from one order and its customer, so a view grows with the tables;
whole-number arithmetic on the keys spreads the value combinations the rules care about.
The formulas are SQL text that any engine reads the same way (line breaks are chr(10)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens.operators.records import enrich
from hirelens.session import spread

SITE = "jobs.example.com"
BASE_URL = f"https://{SITE}"


def pick(index: str, *values: str, default: str = "''") -> str:
    """SQL: values[index], the default past the end. Plain words are quoted, the rest
    (starting with =) is taken as SQL."""
    arms = " ".join(f"WHEN {i} THEN {_sql(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} ELSE {default} END"


def _sql(value: str) -> str:
    return value[1:] if value.startswith("=") else f"'{value}'"


K = "CAST(o_orderkey AS STRING)"
_SPAN = (
    "CAST(5 + o_orderkey % 20 AS STRING) || '-' || "
    "CAST(8 + o_orderkey % 20 + o_orderkey % 7 AS STRING)"
)
_SAVED = (
    "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 120 AS STRING) || '位牛友收藏' || chr(10) "
    "ELSE '' END"
)
_MARKS = pick(
    "o_orderkey % 7", "", "='刚刚有人投递过' || chr(10)", "='今天有人投递' || chr(10)",
    "='HR近期来过' || chr(10)", "='刚刚有人投递过' || chr(10) || 'HR刚刚处理简历' || chr(10)",
)
_WORD = pick("o_orderkey % 5", "郑州", "硕士", "腾讯", "JavaScript", "电商")

POSTING_SQL = {
    "ord": "o_orderkey",
    "job_name": pick(
        "o_orderkey % 6", "Java工程师（合肥）", "【25届校招】前端工程师(北京)", "为你推荐", "算法实习生",
        "测试开发（2026届）（郑州）",
    ),
    "company_name": pick("o_orderkey % 8", "体验很好", "腾", "", default="c_name"),
    "salary": (
        "CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN '薪资面议' "
        "WHEN o_orderkey % 17 = 0 THEN '200-300元/天' "
        f"WHEN o_orderkey % 3 = 0 THEN {_SPAN} || 'k · 14薪' "
        f"WHEN o_orderkey % 3 = 1 THEN {_SPAN} || 'K·' || CAST(12 + o_orderkey % 5 AS STRING) || '薪' "
        f"ELSE {_SPAN} || 'K' END"
    ),
    "education": pick("o_orderkey % 5", "本科", "硕士", "博士", "不限"),
    "city": pick("c_nationkey % 6", "", "北京", "上海", "深圳", "杭州", "成都"),
    "job_type": pick("o_orderkey % 7", "后端开发", "前端开发", "测试", "算法"),
    "recruit_count": pick("o_orderkey % 3", "100-499人", "10000人以上"),
    "company_type": "c_mktsegment",
    "company_nature": pick("o_orderkey % 4", "国企", "外企", "上市公司"),
    "graduate_year": pick("o_orderkey % 6", "2025届", "2026届", "毕业不限"),
    "work_days_per_week": pick("o_orderkey % 5", "3", "4", "5"),
    "intern_duration": pick("o_orderkey % 7", "≥3个月", "6个月", "≥12个月"),
    "has_conversion": pick("o_orderkey % 3", "是", "否"),
    "job_desc": f"CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE {_SAVED} || {_MARKS} || {_WORD} END",
    "job_link": f"'{BASE_URL}/jobs/detail/' || {K}",
    "job_id": (
        "CASE WHEN o_orderkey % 97 = 0 THEN '' "
        f"WHEN o_orderkey % 10 = 9 THEN CAST(o_orderkey - 1 AS STRING) ELSE {K} END"
    ),
    "skill_tags": pick("o_orderkey % 5", "Java,Redis", "Python, SQL,", ",Go", "Java,Spark,SQL"),
    "benefit_tags": pick("o_orderkey % 3", "五险一金,餐补", "年终奖"),
    "career_job": "CAST(11000 + o_orderkey % 28 AS INT)",
    "recruit_type": pick("o_orderkey % 4", "校招", "实习", "社招"),
    "o_orderdate": "o_orderdate",
}

_CARD_LINES = [
    pick(
        "ord % 9", "后端开发工程师", " Java开发（北京） ", "招聘", "HR直招产品经理", "国企-校招java开发",
        "北京", "测试工程师实习", "UI设计", default="'运营'",
    ),
    "salary",
    pick("ord % 4", "北京·海淀", "上海", "", "远程"),
    "education",
    pick("ord % 3", "5天/周", "每周3 天 / 周"),
    pick("ord % 5", "最少3个月", "6个月", "实习3 个月以上"),
    pick("ord % 7", "可转正", "无转正", "不转正机会", "优秀转正"),
    pick("ord % 6", "五险一金 餐补", "年终奖,五险一金", "带薪年假"),
    pick("ord % 8", "MongoDB", "Java/Spring", "sql", "机器学习 NLP", "五险一金 JavaScript"),
    pick("ord % 4", "100-499人", "10000人以上"),
    pick("ord % 5", "某某科技有限公司", "=company_name", "公司", "优选智行", "电商"),
    pick("ord % 6", "HR今日在线", "校招高薪榜", "毕业不限", "招2026届", "上市公司"),
    "job_desc",
    pick("ord % 3", "负责平台建设", "　薪资open"),
]
CARD_SQL = {
    "card_id": "ord",
    "card_text": " || chr(10) || ".join(_CARD_LINES),
    "href": pick(
        "ord % 6", "='/jobs/detail/' || CAST(ord AS STRING) || '?x=1'", "=job_link",
        "='jobs/' || CAST(ord AS STRING) || '/'", "https://other.example.net/1", "",
        default="NULL",
    ),
}

_RECORD = (
    """'  {"岗位名称": "' || job_name || '", "城市": "' || city || '", "薪资" : "' || salary """
    """|| '", "job_id": ' || CAST(ord AS STRING) || ', "公司名称": "' || company_name || '"}' || """
    + pick("ord % 2", ",")
)
LINE_SQL = {
    "ord": "ord",
    "value": pick("ord % 16", "[", " ]", "  ", "{bad", default=_RECORD),
}

PAGE_SQL = {
    "page_id": "ord",
    "html": (
        """'<ul><li><a href="/about">x</a></li><li><a class="c" href="/jobs/detail/' || """
        "CAST(ord AS STRING) || " + pick("ord % 3", "?from=list", "/")
        + """ || '">y</a></li><li><a href="' || job_link || '">z</a></li></ul>'"""
    ),
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings_of(rows: DataFrame) -> DataFrame:
    """Posting columns and ``ord`` (input order) from joined orders and customers."""
    return _select(rows, POSTING_SQL)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    customers = table(spark, sf_dir, "customer")
    return postings_of(orders.join(customers, orders["o_custkey"] == customers["c_custkey"]))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with the derived columns the rollups read."""
    return enrich(postings(spark, sf_dir))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing cards: (card_id, card_text, href)."""
    return _select(postings(spark, sf_dir), CARD_SQL)


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, value): lines of a pretty array file - records, brackets, blanks and junk."""
    return _select(postings(spark, sf_dir), LINE_SQL)


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html): one small listing page per posting with a job link and another one."""
    return _select(postings(spark, sf_dir), PAGE_SQL)
