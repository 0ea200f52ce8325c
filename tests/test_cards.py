"""Card parsing on hand-made cards and against a plain line-by-line restatement."""

import random

from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.operators import cards as C

BASE = "https://jobs.example.com"


def parse(spark, rows, **more):
    df = spark.createDataFrame(rows, "card_id bigint, card_text string, href string, edu string")
    return [r.asDict() for r in C.parse_cards(df, BASE, **more).orderBy("card_id").collect()]


def card(*lines):
    return "\n".join(lines)


def test_full_card(spark):
    text = card(
        "后端开发工程师", "15-25K·14薪", "北京", "本科", "5天/周", "最少3个月", "可转正", "五险一金",
        "MongoDB", "100-499人", "某某科技有限公司",
    )
    got = parse(spark, [(1, text, "/jobs/detail/123?x=1", None)])[0]
    expected = {
        "job_name": "后端开发工程师", "job_type": "后端开发", "salary": "15-25K·14薪", "city": "北京",
        "education": "本科", "work_days_per_week": "5", "intern_duration": "≥3个月",
        "has_conversion": "是", "benefit_tags": "五险一金", "skill_tags": "Go,MongoDB",
        "recruit_count": "100-499人", "company_name": "某某科技有限", "job_id": "123", "job_desc": "",
        "job_link": BASE + "/jobs/detail/123?x=1",
    }
    assert {k: got[k] for k in expected} == expected


def test_empty_and_null_cards(spark):
    for got in parse(spark, [(1, "", None, None), (2, None, "", None)]):
        assert got["job_name"] == "" and got["company_name"] == "" and got["job_desc"] == ""
        assert got["skill_tags"] is None and got["benefit_tags"] is None


def test_degree_hint_comes_first(spark):
    text = card("算法工程师岗", "硕士优先", "本科")
    hinted, plain = parse(
        spark, [(1, text, None, "博士及以上"), (2, text, None, "x")], degree_hint="edu"
    )
    assert (hinted["education"], plain["education"]) == ("博士", "硕士")
    # a hint uses up no line
    assert "硕士优先" in hinted["job_desc"] and "硕士优先" not in plain["job_desc"]


def test_terms_allow_any_blank(spark):
    got = parse(spark, [(1, card("算法工程师岗", "3　天 / 周", "至少 6\xa0个月"), None, None)])[0]
    assert (got["work_days_per_week"], got["intern_duration"]) == ("3", "6个月")


def test_rejection(spark):
    rows = [
        ("ab", "公司甲", BASE), ("算法工程师", "公司甲", "https://x.example"),
        ("直达官网开发", "公司甲", BASE), ("石家庄", "公司甲", BASE), ("abc", "公司甲", BASE),
        ("算法工程师", "甲", BASE), ("算法工程师", "薪资面议", BASE), ("算法工程师", "公司甲", BASE),
    ]
    df = spark.createDataFrame(rows, "job_name string, company_name string, job_link string")
    got = [r[0] for r in df.select(C.rejection("jobs.example.com")).collect()]
    assert got == [
        "title_too_short", "bad_link", "invalid_word", "title_is_place_or_degree", "title_too_short",
        "bad_company", "company_is_pay", None,
    ]
    assert C.valid_cards(df, "jobs.example.com").count() == 1


def by_hand(lines):
    """Title, company, skills and description, one line at a time."""
    used = set()

    def has(line, words):
        return any(w in line for w in words)

    title = ""
    for i, line in enumerate(lines[:10]):
        if has(line, V.CARD_TITLE_WORDS) and len(line) >= 4 and not has(line, V.CARD_TITLE_BANNED):
            title = line
            used.add(i)
            break
    if not title and lines and len(lines[0]) >= 4:
        title = lines[0]
        used.add(0)
    refused = V.CARD_NOT_COMPANY_LINES + V.CARD_NOT_COMPANY_CITIES + V.CARD_NOT_COMPANY_INDUSTRIES
    people = lambda x: "人" in x and ("-" in x or "以上" in x)
    usable = [
        (i, x) for i, x in enumerate(lines)
        if x not in refused and not has(x, V.CARD_NOT_COMPANY_PARTS) and not people(x)
        and x != title and 2 <= len(x) <= 40
    ]
    company = ""
    if usable:
        used.add(usable[-1][0])
        company = usable[-1][1]
    for i, x in reversed(usable):
        if has(x, V.CARD_COMPANY_WORDS):
            used.add(i)
            company = x.replace("公司", "").strip()
            break
    first = lambda test: next((i for i, x in enumerate(lines) if test(x)), None)
    used.add(first(lambda x: has(x.replace(" ", ""), V.CARD_PAY_PARTS)))
    for words in (V.CARD_CITIES, V.CARD_DEGREES, V.CARD_INDUSTRIES, V.CARD_NATURES):
        used.add(first(lambda x, words=words: has(x, words)))
    if not has(title, V.CARD_JOB_TYPES):
        used.add(first(lambda x: has(x, V.CARD_JOB_TYPES)))
    used.add(first(people))
    skills, benefits = [], []
    for i, x in enumerate(lines):
        for words, found, low in ((V.CARD_BENEFITS, benefits, False), (V.CARD_SKILLS, skills, True)):
            for w in words:
                hit = w.lower() in x.lower() if low else w in x
                if hit and w not in found:
                    found.append(w)
                    used.add(i)
    free = [x for i, x in enumerate(lines) if i not in used and not has(x, V.CARD_PROMO_PARTS)]
    return title, company, ",".join(skills) or None, ",".join(benefits) or None, "\n".join(free)


def test_random_cards_against_a_line_by_line_search(spark):
    rng = random.Random(7)
    pool = [
        "后端开发工程师", "Java开发", "HR直招产品经理", "北京", "上海·浦东", "本科", "硕士", "15-25K·14薪",
        "200-300 元/天", "100-499人", "某某科技有限公司", "公司", "优选智行", "电商", "游戏", "国企",
        "五险一金 餐补", "带薪年假", "MongoDB", "java/spring", "SQL", "负责平台建设", "投后必反馈",
        "校招高薪榜必看", "运营", "UI设计", "x", "机器学习", "外企", "优选智行", "本科", "团队氛围好",
    ]
    cards = [[rng.choice(pool) for _ in range(rng.randint(0, 14))] for _ in range(400)]
    got = parse(spark, [(i, "\n".join(f" {x} " for x in c), None, None) for i, c in enumerate(cards)])
    for c, row in zip(cards, got):
        names = ("job_name", "company_name", "skill_tags", "benefit_tags", "job_desc")
        assert tuple(row[n] for n in names) == by_hand(c), c


def test_filter_stays_above_the_parse(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "card_id bigint, card_text string, href string, edu string")
    plan = C.valid_cards(C.parse_cards(df, BASE), "jobs.example.com")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.startswith("Filter") and text.index("Filter") < text.index("CollectMetrics")
    assert text.count("\n") < 60 and "BatchEvalPython" not in text
    assert C.rejected_counts(C.parse_cards(df, BASE), "jobs.example.com").select(F.sum("card_count")).first()[0] == 1
