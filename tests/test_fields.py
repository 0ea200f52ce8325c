"""Field rules on hand-made texts; expected values follow from the rules."""

from pyspark.sql import functions as F

from hirelens.functions import description, links, numbers, repair, salary, text, title


def table(spark, values, *columns):
    """{input: (outputs)} of column expressions over a one-column table."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()
    return {r[0]: tuple(r[1:]) for r in out}


def test_strip(spark):
    got = table(spark, ["　 a b \n", "​x", "", None], text.strip("v"))
    assert got == {"　 a b \n": ("a b",), "​x": ("​x",), "": ("",), None: ("",)}


def test_salary_struct(spark):
    cases = {
        "15-25K·14薪": (15, 25, 14, False, "15-25K·14薪"),
        "9-11k · 14薪": (9, 11, 14, False, "9-11K·14薪"),
        "20-30K": (20, 30, 12, False, "20-30K"),
        "15-25K14薪": (15, 25, 12, False, "15-25K14薪"),
        "10-20K·": (10, 20, 12, False, "10-20K·"),
        "20K～40K": (None, None, None, False, "20K～40K"),
        "200-300元/天": (None, None, None, False, "200-300元/天"),
        "薪资面议": (None, None, None, True, "薪资面议"),
        "9 - 11K": (9, 11, 12, False, "9-11K"),
        "5-6K 10-20K·14薪": (10, 20, 14, False, "5-6K10-20K·14薪"),
        "x1-2K.13薪y": (1, 2, 13, False, "x1-2K.13薪y"),
    }
    got = table(spark, [*cases, "", None], salary.salary_struct("v"))
    assert {k: tuple(v[0]) for k, v in got.items() if k} == cases
    assert got[""] == (None,) and got[None] == (None,)


def test_salary_yuan(spark):
    cases = {
        "15-25K·14薪": (15000, 25000, 14, False),
        "9-11k · 14薪": (9000, 11000, 14, False),
        "20-30K": (20000, 30000, 12, False),
        "15-25K14薪": (15000, 25000, 14, False),
        "10-20K·": (10000, 20000, 12, False),
        "20K～40K": (None, None, 12, False),
        "200-300元/天": (None, None, 12, False),
        "薪资面议": (None, None, None, True),
        "": (None, None, None, True),
        "9 - 11K": (None, None, 12, False),
        "99999999999999999999-2K": (None, 2000, 12, False),
        None: (None, None, None, True),
    }
    got = table(
        spark, list(cases), salary.min_yuan("v"), salary.max_yuan("v"), salary.months_paid("v"),
        salary.is_negotiable("v"),
    )
    assert got == cases
    mid = table(spark, ["15-20K·14薪"], salary.midpoint(salary.min_yuan("v"), salary.max_yuan("v")))
    assert mid == {"15-20K·14薪": (17500,)}


def test_titles(spark):
    cases = {
        "Java工程师（合肥）": ("Java工程师（合肥）", "合肥", None, "合肥"),
        "【25届校招】Java工程师（合肥）": ("【25届校招】Java工程师（合肥）", "合肥", "25届", "合肥"),
        "测试（2026届）（郑州）": ("测试（2026届）（郑州）", None, "2026届", "郑州"),
        "岗(Java)": ("岗(Java)", None, None, "未知"),
        "工程师（内推优先）": ("工程师（内推优先）", "内推优先", None, "未知"),
        "Java工程师-26届校招-J15117": ("Java工程师-26届校招-J15117", None, "26届", "未知"),
        "为你推荐": ("未知", None, None, "未知"),
        "  ": ("未知", None, None, "未知"),
        "测(上海市浦东新区)": ("测(上海市浦东新区)", None, None, "未知"),
    }
    name = title.clean_title("v")
    got = table(
        spark, list(cases), name, title.city_in_title(name), title.batch_in_title(name),
        title.effective_city(F.lit(""), "v"),
    )
    assert got == cases


def test_given_city_wins(spark):
    got = table(spark, ["x（合肥）"], title.effective_city(F.lit("北京"), "v"))
    assert got == {"x（合肥）": ("北京",)}


def test_standard_titles(spark):
    cases = {
        "JAVA开发工程师（2026届校招）-武汉": ("JAVA开发工程师", None),
        "2026届秋招-Java后台开发工程师": ("Java后台开发工程师", None),
        "Java工程师-26届校招-J15117": ("Java工程师", "J15117"),
        "【25届校招】Java工程师（合肥）": ("Java工程师", None),
    }
    got = table(spark, list(cases), title.standard_title("v"), title.job_code("v"))
    assert got == cases
    pay = table(spark, ["京东零售Java后端工程师20K～40K", "Java"], title.pay_in_title("v"))
    assert pay == {"京东零售Java后端工程师20K～40K": ("20-40K",), "Java": (None,)}


def test_descriptions(spark):
    cases = {
        "195位牛友收藏\n高新技术": (195, "", "", None, None, None, None),
        "刚刚有人投递过\n郑州\n本科\njava多线程\n数字马力": (
            0, "刚刚有人投递过", "刚刚有人投递过", "郑州", "本科", "后端开发", "数字马力",
        ),
        "51位牛友收藏\n本科\n海能达通信": (51, "", "", None, "本科", None, "海能达"),
        "今天有人投递\nHR近期来过": (0, "HR近期来过", "今天有人投递", None, None, None, None),
        "博士\n硕士": (0, "", "", None, "博士", None, None),
        "JavaScript": (0, "", "", None, None, "后端开发", None),
        "email": (0, "", "", None, None, "AI", None),
        "HR刚刚处理简历 刚刚有人投递过 上海 北京": (
            0, "刚刚有人投递过|HR刚刚处理简历", "刚刚有人投递过", "北京", None, None, None,
        ),
        "位牛友收藏": (0, "", "", None, None, None, None),
    }
    got = table(
        spark, list(cases), description.favourites("v"), description.activity_marks("v"),
        description.activity_label("v"), description.city_in_text("v"),
        description.degree_in_text("v"), description.family_in_text("v"),
        description.company_in_text("v"),
    )
    assert got == cases


def test_signals(spark):
    got = table(spark, ["薪资超87%同类职位\n还有1天截止\nHC充足榜", ""], description.signals("v"))
    assert got["薪资超87%同类职位\n还有1天截止\nHC充足榜"] == (
        ["pay_percentile:87", "deadline_days:1", "board:HC充足榜"],
    )
    assert got[""] == ([],)


def test_repairs(spark):
    got = table(spark, ["体验很好", "腾", "", "腾讯"], repair.is_company_tag("v"))
    assert got == {"体验很好": (True,), "腾": (True,), "": (True,), "腾讯": (False,)}
    got = table(spark, ["不限", "", "本科"], repair.repaired_degree("v", F.lit("硕士")))
    assert got == {"不限": ("硕士",), "": ("硕士",), "本科": ("本科",)}
    got = table(spark, ["广东叶子科技发展有限​", "好公司"], repair.visible_company("v"))
    assert got == {"广东叶子科技发展有限​": ("广东叶子科技发展有限公司",), "好公司": ("好公司",)}
    tags = table(
        spark, ["HR近期来过", ""], repair.value_tags(F.lit(10), "v"),
        repair.value_tags(F.lit(9), "v", hr_tag=True),
    )
    assert tags == {"HR近期来过": (["高收藏", "活跃"], ["活跃", "HR活跃"]), "": (["高收藏"], [])}


def test_content_key_collides_as_text(spark):
    df = spark.createDataFrame([("A_B", "C", "X"), ("A", "B_C", "X")], "a string, b string, c string")
    assert df.select(repair.content_key("a", "b", "c")).distinct().count() == 1


def test_skills(spark):
    got = table(spark, [",Java, ,Go,", "Java,Java", "", None], text.split_tags("v"))
    assert got == {
        ",Java, ,Go,": (["Java", "Go"],), "Java,Java": (["Java", "Java"],), "": ([],), None: ([],),
    }


def test_links(spark):
    link = links.absolute_link("v", "https://jobs.example.com")
    cases = {
        "/jobs/detail/123?x=1": ("https://jobs.example.com/jobs/detail/123?x=1", "123"),
        "https://a.example/9/": ("https://a.example/9/", "9"),
        "jobs/7": ("https://jobs.example.com/jobs/7", "7"),
        "/about": ("https://jobs.example.com/about", ""),
    }
    assert table(spark, list(cases), link, links.id_from_link(link)) == cases
    types = table(spark, ["a/school", "a/intern", "a/fulltime", "a"], links.recruit_type_from_url("v"))
    assert types == {"a/school": ("校招",), "a/intern": ("实习",), "a/fulltime": ("社招",), "a": ("未知",)}


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (0, 5), (0, 0)], "p bigint, t bigint")
    got = df.select(
        numbers.percent(F.col("p"), F.col("t")), numbers.percent_text(F.col("p"), F.col("t"))
    ).collect()
    assert [tuple(r) for r in got] == [(0.13, "0.13"), (33.33, "33.33"), (0.0, "0.00"), (0.0, "0.00")]
