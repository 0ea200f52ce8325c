"""The registered queries as SQL for an independent engine, name -> text.

Only the posting-shaped views and the fixed word lists are shared with the Spark
queries; every rule is written again in plain SQL.
"""

from __future__ import annotations

from hirelens import vocab as V
from hirelens.functions.text import UNICODE_BLANKS
from hirelens.plans import views
from hirelens.schema import COLUMNS, EXPORT_COLUMNS, SERVING, SOURCE_KEYS


def listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def in_(text: str, words: list[str]) -> str:
    return f"{text} IN ({', '.join(repr(w) for w in words)})"


def any_(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def first_(text: str, words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({text}, '{w}') THEN '{w}'" for w in words) + " END"


def strip(text: str) -> str:
    return f"trim({text}, '{UNICODE_BLANKS}')"


def number(text: str, pattern: str, group: int = 1) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '{pattern}', {group}), '') AS BIGINT)"


def pct(part: str, total: str) -> str:
    return f"(((({part}) * 20000 + ({total})) // (2 * ({total}))) / 100)"


def _view(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + f" FROM {source}"


POSTINGS = "postings AS (" + _view(views.POSTING_SQL, "orders JOIN customer ON o_custkey = c_custkey") + ")"

JOBS = f"""{POSTINGS}, base AS (
  SELECT *, (salary = '' OR contains(salary, '面议')) AS negotiable,
    regexp_extract(job_name, '{V.RE_TITLE_CITY}', 1) AS bracket
  FROM postings
), jobs0 AS (
  SELECT *,
    CASE WHEN city <> '' THEN city WHEN {in_('bracket', V.TITLE_CITIES)} THEN bracket ELSE '未知' END
      AS effective_city,
    CASE WHEN NOT negotiable THEN {number('salary', V.RE_PAY_ANY_CASE, 1)} * 1000 END AS min_salary,
    CASE WHEN NOT negotiable THEN {number('salary', V.RE_PAY_ANY_CASE, 2)} * 1000 END AS max_salary,
    CASE WHEN NOT negotiable THEN coalesce({number('salary', V.RE_MONTHS)}, 12) END AS salary_months,
    coalesce({number('job_desc', V.RE_FAVOURITES)}, 0) AS collection_count,
    coalesce({first_('job_desc', V.ACTIVE_LABELS)}, '') AS activity_label,
    (recruit_type = '实习' OR contains(job_name, '实习')) AS is_internship,
    list_filter(list_transform(string_split(skill_tags, ','), lambda x: trim(x)), lambda x: x <> '') AS skills
  FROM base
), jobs AS (
  SELECT *, (min_salary + max_salary) // 2 AS mid, activity_label <> '' AS is_active,
    collection_count >= 50 AS is_high
  FROM jobs0
), skilled AS (SELECT *, unnest(skills) AS skill FROM jobs)"""

# Description and title rules of the cleaning step, over any relation with posting columns.
def _cleaned(source: str) -> str:
    d = "d"
    families = " ".join(
        f"WHEN {any_('upper(d)', [w.upper() for w in words])} THEN '{name}'"
        for name, words in V.JOB_FAMILIES.items()
    )
    marks = ", ".join(f"CASE WHEN contains(d, '{m}') THEN '{m}' END" for m in V.ACTIVITY_MARKS)
    bracket = f"nullif(regexp_extract(clean_title, '{V.RE_TITLE_BRACKET}', 1), '')"
    batch = f"nullif(regexp_extract(clean_title, '{V.RE_TITLE_BATCH}', 1), '')"
    return f"""c0 AS (
  SELECT *, {strip('job_desc')} AS d, {strip('company_name')} AS company0, {strip('city')} AS city0,
    {strip('education')} AS degree0, {strip('job_type')} AS type0, {strip('salary')} AS salary0,
    CASE WHEN {strip('job_name')} = '' OR contains(job_name, '为你推荐') THEN '未知'
      ELSE {strip('job_name')} END AS clean_title
  FROM {source}
), c1 AS (
  SELECT *,
    coalesce({number(d, V.RE_FAVOURITES)}, 0) AS favourites,
    concat_ws('|', {marks}) AS activity_marks,
    {first_(d, V.DESC_CITIES)} AS city_candidate,
    {first_(d, V.DEGREES)} AS degree_candidate,
    CASE {families} END AS job_family,
    {first_(d, V.KNOWN_COMPANIES)} AS company_candidate,
    CASE WHEN length({bracket}) BETWEEN 2 AND 5 AND NOT regexp_matches({bracket}, '^[a-zA-Z0-9]')
      THEN {bracket} END AS city_from_title,
    {batch} || '届' AS title_batch,
    replace(replace(salary0, 'k', 'K'), ' ', '') AS raw_pay,
    ({in_('company0', V.COMPANY_TAGS)} OR length(company0) < 2) AS is_tag
  FROM c0
), c2 AS (
  SELECT *,
    contains(raw_pay, '面议') AS nego,
    coalesce({number('raw_pay', V.RE_PAY_WITH_MONTHS, 1)}, {number('raw_pay', V.RE_PAY, 1)}) AS lo,
    coalesce({number('raw_pay', V.RE_PAY_WITH_MONTHS, 2)}, {number('raw_pay', V.RE_PAY, 2)}) AS hi,
    {number('raw_pay', V.RE_PAY_WITH_MONTHS, 3)} AS stated_months,
    CASE WHEN is_tag THEN coalesce(company_candidate, '未知') ELSE company0 END AS new_company,
    coalesce(nullif(city0, ''), city_from_title, city_candidate, '') AS new_city,
    CASE WHEN degree0 IN ('', '不限') THEN coalesce(degree_candidate, degree0) ELSE degree0 END AS new_degree,
    coalesce(nullif(type0, ''), job_family, '') AS new_type
  FROM c1
), cleaned AS (
  SELECT *,
    CASE WHEN salary0 <> '' AND NOT nego THEN lo END AS pay_min,
    CASE WHEN salary0 <> '' AND NOT nego THEN hi END AS pay_max,
    CASE WHEN salary0 <> '' AND NOT nego AND lo IS NOT NULL THEN coalesce(stated_months, 12) END AS pay_months,
    CASE WHEN salary0 <> '' THEN nego END AS pay_negotiable,
    CASE WHEN salary0 <> '' THEN raw_pay END AS pay_raw,
    new_company || '_' || clean_title || '_' || new_city AS content_key,
    concat_ws('|', CASE WHEN favourites >= 10 THEN '高收藏' END,
      CASE WHEN activity_marks <> '' THEN '活跃' END) AS value_tags
  FROM c2
)"""


KEPT = """kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ord) AS rn FROM postings)
  WHERE rn = 1 OR job_id = ''
)"""
CLEANED = f"{POSTINGS}, {KEPT}, {_cleaned('kept')}"
CLEANED_ALL = f"{POSTINGS}, {_cleaned('postings')}"

FLAT = """SELECT ord, job_id, clean_title AS job_name, new_company AS company_name, new_city AS city,
  new_degree AS education, new_type AS job_type, salary, clean_title <> '未知' AS is_valid_job,
  pay_min, pay_max, pay_months, pay_negotiable, pay_raw, favourites AS collection_count,
  activity_marks AS active_status, coalesce(title_batch, graduate_year) AS batch, value_tags
FROM cleaned"""


def _salary_stats(key: str, name: str, source: str = "jobs", where: str = "true") -> str:
    return (
        f"SELECT {key} AS {name}, CAST(sum(mid) // count(mid) AS BIGINT) AS avg_salary, "
        "min(min_salary) AS min_salary, max(max_salary) AS max_salary, count(*) AS job_count "
        f"FROM {source} WHERE mid IS NOT NULL AND {where} GROUP BY 1"
    )


def _counts(key: str, name: str, n: str, source: str = "jobs", where: str = "true") -> str:
    return f"SELECT {key} AS {name}, count(*) AS {n} FROM {source} WHERE {where} GROUP BY 1"


def _zero_filled(count: str, where: str) -> str:
    return (
        f"SELECT effective_city AS city, count(*) AS {count}, "
        "CAST(sum(coalesce(mid, 0)) // count(*) AS BIGINT) AS avg_salary "
        f"FROM jobs WHERE {where} GROUP BY 1"
    )


def _ratio(key: str, name: str) -> str:
    part = "count(*) FILTER (WHERE negotiable)"
    return (
        f"SELECT {key} AS {name}, count(*) AS total_count, {part} AS negotiable_count, "
        f"{pct(part, 'count(*)')} AS negotiable_ratio FROM jobs GROUP BY 1"
    )


DASH = """dash AS (
  SELECT 'total_jobs' AS metric_name, CAST(count(*) AS VARCHAR) AS metric_value FROM jobs
  UNION ALL SELECT 'avg_salary', CAST(CAST(sum(mid) // count(mid) AS BIGINT) AS VARCHAR) FROM jobs
  UNION ALL SELECT 'valid_salary_jobs', CAST(count(mid) AS VARCHAR) FROM jobs
)"""

HIGH = """SELECT effective_city AS city, count(*) AS high_collection_count,
  CAST(sum(collection_count) AS BIGINT) AS total_collection{more}
FROM jobs WHERE is_high GROUP BY 1"""

_MEAN = "CAST(sum(mid) // count(mid) AS BIGINT)"


def _quantiles(key: str, source: str = "jobs", where: str = "true") -> str:
    ps = ", ".join(f"round(quantile_cont(mid, {p / 100}), 2) AS p{p}" for p in (25, 50, 75, 90))
    return (
        f"SELECT {key}, count(*) AS job_count, {ps} FROM {source} "
        f"WHERE mid IS NOT NULL AND {where} GROUP BY 1"
    )


def _share(key: str) -> str:
    total = "(SELECT count(*) FROM jobs)"
    return (
        f"SELECT {key}, count(*) AS total_count, {_MEAN} AS avg_salary, min(CASE WHEN mid IS NOT NULL THEN "
        "min_salary END) AS min_salary, max(CASE WHEN mid IS NOT NULL THEN max_salary END) AS max_salary, "
        f"count(mid) AS salaried_count, {pct('count(*)', total)} AS share FROM jobs GROUP BY 1"
    )


def _cube(a: str, b: str) -> str:
    return (
        f"SELECT CASE WHEN grouping({a}) = 1 THEN 'ALL' ELSE {a} END AS {a}, "
        f"CASE WHEN grouping({b}) = 1 THEN 'ALL' ELSE {b} END AS {b}, count(*) AS job_count "
        f"FROM jobs GROUP BY CUBE ({a}, {b})"
    )


def _two_decimals(total: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST(({total} * 200 + {n}) // (2 * {n}) AS BIGINT) / 100 END"


def _terms(keys: str) -> str:
    months = number("intern_duration", "([0-9]+)个月")
    days = "TRY_CAST(nullif(work_days_per_week, '') AS BIGINT)"
    yes = "count(*) FILTER (WHERE has_conversion = '是')"
    said = "count(*) FILTER (WHERE has_conversion IN ('是', '否'))"
    return (
        f"SELECT {keys}, count(*) AS internship_count, "
        f"{_two_decimals(f'sum({months})', f'count({months})')} AS avg_duration, "
        f"{_two_decimals(f'sum({days})', f'count({days})')} AS avg_days, "
        f"CASE WHEN {said} > 0 THEN {pct(yes, said)} END AS conversion_rate "
        f"FROM jobs WHERE is_internship GROUP BY ALL"
    )


def _profile(fields: list[str], source: str, names: dict[str, str] | None = None, rate: str = "rate") -> str:
    rows = []
    for f in fields:
        c = (names or {}).get(f, f)
        filled = (
            f"count({c})" if f in ("ord", "career_job") else f"count(*) FILTER (WHERE coalesce({c}, '') <> '')"
        )
        rows.append(
            f"SELECT '{f}' AS field, {filled} AS filled, count(*) AS total, "
            f"{pct(filled, 'count(*)')} AS {rate} FROM {source}"
        )
    return " UNION ALL ".join(rows)


def _all_rollups() -> str:
    dims = {
        "effective_city": "effective_city", "education": "education", "company_type": "company_type",
        "recruit_type": "recruit_type",
        "activity_type": "CASE WHEN is_active THEN '活跃' ELSE '非活跃' END", "ALL": "'ALL'",
    }
    measures = """count(*) AS job_count, count(mid) AS salaried_count, CAST(sum(mid) AS BIGINT) AS salary_total,
      min(min_salary) AS min_salary, max(max_salary) AS max_salary,
      count(*) FILTER (WHERE is_internship) AS internship_count,
      CAST(sum(coalesce(mid, 0)) FILTER (WHERE is_internship) AS BIGINT) AS internship_salary_total,
      count(*) FILTER (WHERE is_active) AS active_count,
      CAST(sum(coalesce(mid, 0)) FILTER (WHERE is_active) AS BIGINT) AS active_salary_total,
      count(*) FILTER (WHERE is_high) AS high_collection_count,
      CAST(sum(collection_count) FILTER (WHERE is_high) AS BIGINT) AS total_collection,
      count(mid) FILTER (WHERE is_high) AS high_salaried_count,
      CAST(sum(mid) FILTER (WHERE is_high) AS BIGINT) AS high_salary_total,
      count(*) FILTER (WHERE negotiable) AS negotiable_count"""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {sql} AS value, {measures} FROM jobs GROUP BY 2"
        for name, sql in dims.items()
    )


STANDARD_TITLE = "clean_title"
for _pattern in (
    r"[\[【](?:20)?[0-9]{2}届?(?:校招|秋招)?[\]】]", r"[（(](?:20)?[0-9]{2}届?(?:校招|秋招)?[）)]",
    r"(?:20)?[0-9]{2}届(?:校招|秋招)?", r"[（(][一-龥]{2,5}[）)]", V.RE_JOB_CODE,
    "-(?:" + "|".join(V.DESC_CITIES) + ")$",
):
    STANDARD_TITLE = f"regexp_replace({STANDARD_TITLE}, '{_pattern}', '', 'g')"
STANDARD_TITLE = f"trim(regexp_replace({STANDARD_TITLE}, '-{{2,}}', '-', 'g'), '- ')"

LINES = f"{POSTINGS}, text_lines AS ({_view(views.LINE_SQL, 'postings')})"


def _absolute(href: str) -> str:
    base = views.BASE_URL
    return (
        f"CASE WHEN starts_with({href}, '/') THEN '{base}' || {href} "
        f"WHEN starts_with({href}, 'http') THEN {href} ELSE '{base}/' || {href} END"
    )


def _id(link: str) -> str:
    return (
        f"coalesce(nullif(regexp_extract({link}, '{V.RE_TRAILING_ID}', 1), ''), "
        f"nullif(regexp_extract({link}, '{V.RE_DETAIL_ID}', 1), ''), '')"
    )


def _page_links(source: str, pattern: str) -> str:
    return f"""found AS (
  SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS nth, unnest(l) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="({pattern})"', 1) AS l FROM {source})
), linked AS (SELECT *, {_absolute('href')} AS link FROM found)
SELECT page_id, nth, href, link, {_id('link')} AS job_id FROM linked"""


# --- listing cards ---------------------------------------------------------------


def _at(test: str) -> str:
    return f"coalesce(list_position(list_transform(lines, lambda x: {test}), true), 0)"


def _words(words: list[str], lines: str) -> str:
    """Words by first line, then by list order."""
    low = listed([w.lower() for w in words])
    places = (
        f"list_transform(range(1, {len(words) + 1}), lambda i: {{'p': coalesce(list_position("
        f"list_transform({lines}, lambda x: contains(x, {low}[i])), true), 0), 'i': i}})"
    )
    return f"list_sort(list_filter({places}, lambda s: s.p > 0))"


def _parsed_cards() -> str:
    people = "(contains(x, '人') AND (contains(x, '-') OR contains(x, '以上')))"
    refused = V.CARD_NOT_COMPANY_LINES + V.CARD_NOT_COMPANY_CITIES + V.CARD_NOT_COMPANY_INDUSTRIES
    candidate = (
        f"(NOT {in_('x', refused)} AND NOT {any_('x', V.CARD_NOT_COMPANY_PARTS)} AND NOT {people} "
        "AND x <> job_name AND length(x) BETWEEN 2 AND 40)"
    )
    last = "CASE WHEN {0} IS NULL THEN 0 ELSE len(lines) + 1 - {0} END"
    named = f"list_position(list_reverse(list_transform(lines, lambda x: {candidate} AND {any_('x', V.CARD_COMPANY_WORDS)})), true)"
    bottom = f"list_position(list_reverse(list_transform(lines, lambda x: {candidate})), true)"
    head = (
        f"list_filter(lines[1:10], lambda x: {any_('x', V.CARD_TITLE_WORDS)} AND length(x) >= 4 "
        "AND NOT (contains(x, '发布') OR contains(x, 'HR')))[1]"
    )
    rules = {
        "pay": any_("replace(x, ' ', '')", V.CARD_PAY_PARTS),
        "city": any_("x", V.CARD_CITIES),
        "degree": any_("x", V.CARD_DEGREES),
        "industry": any_("x", V.CARD_INDUSTRIES),
        "people": people,
        "nature": any_("x", V.CARD_NATURES),
        "year": f"({any_('x', V.CARD_YEAR_WORDS)} OR regexp_matches(x, '{V.RE_CARD_YEAR}'))",
        "days": f"regexp_matches(x, '{V.RE_CARD_DAYS}')",
        "term": f"regexp_matches(x, '{V.RE_CARD_TERM}')",
        "conversion": any_("x", V.CARD_CONVERSION_YES + V.CARD_CONVERSION_NO),
    }
    places = ", ".join(f"{_at(test)} AS p_{name}" for name, test in rules.items())
    used = ", ".join(f"p_{n}" for n in [*rules, "type", "named", "bottom", "title"])
    term = "lines[p_term]"

    def line(p: str) -> str:
        return f"coalesce(lines[nullif(p_{p}, 0)], '')"

    def word(p: str, words: list[str]) -> str:
        return f"CASE WHEN p_{p} > 0 THEN {first_(f'lines[p_{p}]', words)} END"

    return f"""{POSTINGS}, cards AS ({_view(views.CARD_SQL, 'postings')}), k0 AS (
  SELECT *, list_filter(list_transform(string_split(card_text, chr(10)), lambda x: {strip('x')}),
    lambda x: x <> '') AS lines FROM cards
), k1 AS (
  SELECT *, coalesce({head}, CASE WHEN length(lines[1]) >= 4 THEN lines[1] END, '') AS job_name,
    list_transform(lines, lambda x: lower(x)) AS low FROM k0
), k2 AS (
  SELECT *, {first_('job_name', V.CARD_JOB_TYPES)} AS title_type,
    CASE WHEN job_name = '' THEN 0 ELSE list_position(lines, job_name) END AS p_title,
    {last.format(named)} AS p_named, {last.format(bottom)} AS p_bottom, {places},
    {_words(V.CARD_BENEFITS, 'lines')} AS benefits, {_words(V.CARD_SKILLS, 'low')} AS wanted
  FROM k1
), k3 AS (
  SELECT *, CASE WHEN title_type IS NULL THEN {_at(any_('x', V.CARD_JOB_TYPES))} ELSE 0 END AS p_type FROM k2
), k4 AS (
  SELECT *, list_concat([{used}], list_transform(benefits, lambda s: s.p), list_transform(wanted, lambda s: s.p)) AS used,
    coalesce({_absolute('href')}, '') AS job_link
  FROM k3
), parsed AS (
  SELECT card_id, job_name,
    CASE WHEN p_named > 0 THEN {strip("replace(lines[p_named], '公司', '')")} ELSE {line('bottom')} END AS company_name,
    {line('pay')} AS salary,
    coalesce({word('city', V.CARD_CITIES)}, '') AS city,
    coalesce({word('degree', V.CARD_DEGREES)}, '') AS education,
    coalesce(title_type, {word('type', V.CARD_JOB_TYPES)}, '') AS job_type,
    coalesce({word('industry', V.CARD_INDUSTRIES)}, '') AS company_type,
    {line('people')} AS recruit_count,
    coalesce({word('nature', V.CARD_NATURES)}, {first_('job_name', V.CARD_NATURES)}, '') AS company_nature,
    coalesce({word('year', V.CARD_YEAR_WORDS)}, regexp_extract({line('year')}, '{V.RE_CARD_YEAR}', 0)) AS graduate_year,
    regexp_extract({line('days')}, '{V.RE_CARD_DAYS}', 1) AS work_days_per_week,
    CASE WHEN p_term = 0 THEN '' ELSE
      CASE WHEN regexp_extract({term}, '{V.RE_CARD_TERM}', 1) <> '' OR regexp_extract({term}, '{V.RE_CARD_TERM}', 3) <> ''
        THEN '≥' ELSE '' END || regexp_extract({term}, '{V.RE_CARD_TERM}', 2) || '个月' END AS intern_duration,
    CASE WHEN p_conversion = 0 THEN '' WHEN {any_('lines[p_conversion]', V.CARD_CONVERSION_YES)} THEN '是' ELSE '否' END
      AS has_conversion,
    CASE WHEN len(benefits) > 0 THEN array_to_string(list_transform(benefits, lambda s: {listed(V.CARD_BENEFITS)}[s.i]), ',') END
      AS benefit_tags,
    CASE WHEN len(wanted) > 0 THEN array_to_string(list_transform(wanted, lambda s: {listed(V.CARD_SKILLS)}[s.i]), ',') END
      AS skill_tags,
    job_link, {_id('job_link')} AS job_id,
    array_to_string(list_filter(lines, lambda x, i: NOT list_contains(used, i) AND NOT {any_('x', V.CARD_PROMO_PARTS)}), chr(10))
      AS job_desc
  FROM k4
), judged AS (
  SELECT *, CASE WHEN length(job_name) < 3 THEN 'title_too_short'
    WHEN NOT contains(job_link, '{views.SITE}') THEN 'bad_link'
    WHEN {any_('job_name', V.CARD_INVALID_TITLE_PARTS)} THEN 'invalid_word'
    WHEN {in_('job_name', V.CARD_INVALID_TITLES)} THEN 'title_is_place_or_degree'
    WHEN length(job_name) < 4 THEN 'title_too_short'
    WHEN length(company_name) < 2 THEN 'bad_company'
    WHEN {in_('company_name', V.CARD_PAY_COMPANIES)} THEN 'company_is_pay' END AS rejection
  FROM parsed
)"""


def _with(cte: str, body: str) -> str:
    return f"WITH {cte} {body}"


def _j(body: str) -> str:
    return _with(JOBS, body)


_METRICS = f"""count(*) AS job_count, {_MEAN} AS avg_salary, min(min_salary) AS min_salary,
  max(max_salary) AS max_salary, count(mid) AS salaried_count, CAST(sum(collection_count) AS BIGINT) AS favourites,
  count(*) FILTER (WHERE is_active) AS active_count, count(*) FILTER (WHERE is_internship) AS internship_count,
  count(*) FILTER (WHERE negotiable) AS negotiable_count"""

_SKILL_FILTER = "effective_city IN ('北京', '上海') AND job_type IN ('后端开发', '测试')"

_PARTS = [("校招", "校招"), ("实习", "实习"), ("社招", "社招"), ("", "未知")]
_PART = "CASE recruit_type " + " ".join(f"WHEN '{g}' THEN {i}" for i, (g, _) in enumerate(_PARTS)) + " END"
_PART_NAME = "CASE recruit_type " + " ".join(f"WHEN '{g}' THEN '{n}'" for g, n in _PARTS) + " END"

_REPORT = """ins AS (SELECT count(*) AS n FROM postings), counts AS (
  SELECT 'input_count' AS metric, n AS value FROM ins
  UNION ALL SELECT 'total_processed', n FROM ins
  UNION ALL SELECT 'output_count', count(*) FROM cleaned
  UNION ALL SELECT 'high_value_count', count(*) FROM cleaned WHERE value_tags <> ''
  UNION ALL SELECT 'duplicate_id', (SELECT n FROM ins) - count(*) FROM cleaned
  UNION ALL SELECT 'company_restored_from_desc', count(*) FROM cleaned WHERE is_tag AND company_candidate IS NOT NULL
  UNION ALL SELECT 'company_unknown', count(*) FROM cleaned WHERE is_tag AND company_candidate IS NULL
  UNION ALL SELECT 'city_restored_from_title', count(*) FROM cleaned WHERE city0 = '' AND city_from_title IS NOT NULL
  UNION ALL SELECT 'city_restored_from_desc', count(*) FROM cleaned
    WHERE city0 = '' AND city_from_title IS NULL AND city_candidate IS NOT NULL
  UNION ALL SELECT 'degree_restored_from_desc', count(*) FROM cleaned
    WHERE degree0 IN ('', '不限') AND degree_candidate IS NOT NULL
  UNION ALL SELECT 'type_restored_from_desc', count(*) FROM cleaned WHERE type0 = '' AND job_family IS NOT NULL
  UNION ALL SELECT 'duplicate_content_warning', count(*) - count(DISTINCT content_key) FROM cleaned
) SELECT metric, CAST(value AS BIGINT) AS value FROM counts
WHERE value > 0 OR metric IN ('input_count', 'output_count', 'high_value_count')"""

_CHANGED = ["job_name", "company_name", "city", "education", "job_type"]
_CHANGED_TO = {
    "job_name": "clean_title", "company_name": "new_company", "city": "new_city",
    "education": "new_degree", "job_type": "new_type",
}

ORACLES: dict[str, str] = {
    # rollups
    "city_job_count": _j(_counts("effective_city", "city", "job_count")),
    "city_salary_stats": _j(_salary_stats("effective_city", "city")),
    "skill_count": _j(_counts("skill", "skill", "count", "skilled")),
    "skill_salary_stats": _j(_salary_stats("skill", "skill", "skilled")),
    "education_count": _j(_counts("education", "education", "count", where="education <> ''")),
    "education_salary_stats": _j(_salary_stats("education", "education", where="education <> ''")),
    "company_type_count": _j(_counts("company_type", "company_type", "count", where="company_type <> ''")),
    "recruit_type_count": _j(_counts("recruit_type", "recruit_type", "count", where="recruit_type <> ''")),
    "internship_stats": _j(_zero_filled("internship_count", "is_internship")),
    "dashboard_summary": _with(f"{JOBS}, {DASH}", "SELECT * FROM dash"),
    "high_collection": _j(HIGH.format(more="")),
    "high_collection_salary": _j(HIGH.format(more=f", {_MEAN} AS avg_salary")),
    "active_jobs": _j(_zero_filled("active_count", "is_active")),
    "negotiable_ratio": _j(_ratio("effective_city", "city")),
    "skill_collection_rank": _j(
        "SELECT skill, CAST(sum(collection_count) AS BIGINT) AS total_collection, count(*) AS job_count "
        "FROM skilled WHERE is_high GROUP BY 1"
    ),
    "activity_salary": _j(
        _salary_stats("CASE WHEN is_active THEN '活跃' ELSE '非活跃' END", "activity_type")
    ),
    "all_rollups": _j(_all_rollups()),
    # top-k and ranks
    "top10_cities": _j(
        _counts("effective_city", "city", "job_count") + " ORDER BY job_count DESC, city LIMIT 10"
    ),
    "top100_favourites": _j(
        "SELECT ord, job_id, job_name, company_name, collection_count FROM jobs "
        "ORDER BY collection_count DESC, ord LIMIT 100"
    ),
    "skill_ranking_filtered": _j(
        f"SELECT *, CAST(rank() OVER (ORDER BY count DESC) AS BIGINT) AS skill_rank FROM "
        f"({_counts('skill', 'skill', 'count', 'skilled', _SKILL_FILTER)})"
    ),
    # field rules
    "salary_struct": _with(
        CLEANED_ALL, "SELECT ord, pay_min, pay_max, pay_months, pay_negotiable, pay_raw FROM cleaned"
    ),
    "salary_yuan": _j(
        "SELECT ord, min_salary, max_salary, salary_months, negotiable, mid AS avg_monthly_salary, "
        "mid * salary_months AS annual_salary FROM jobs"
    ),
    "job_fields": _j(
        "SELECT ord, effective_city, collection_count, activity_label, is_active, is_internship, "
        "is_high AS is_high_collection, array_to_string(skills, '|') AS skills FROM jobs"
    ),
    "description_fields": _with(
        CLEANED_ALL,
        "SELECT ord, favourites, activity_marks, city_candidate, degree_candidate, job_family, "
        "company_candidate FROM cleaned",
    ),
    "document_fields": (
        f"WITH docs AS (SELECT doc_id, {strip('text')} AS d FROM documents) SELECT doc_id, CASE "
        + " ".join(
            f"WHEN {any_('upper(d)', [w.upper() for w in words])} THEN '{name}'"
            for name, words in V.JOB_FAMILIES.items()
        )
        + f" END AS job_family, {first_('d', V.KNOWN_COMPANIES)} AS company_candidate, "
        "CAST(length(d) AS INTEGER) AS text_length FROM docs"
    ),
    "title_fields": _with(
        CLEANED_ALL,
        "SELECT ord, clean_title, city_from_title, title_batch, clean_title <> '未知' AS is_valid_job, "
        f"{STANDARD_TITLE} AS standard_title, "
        f"nullif(regexp_extract(job_name || '-J' || job_id, '{V.RE_JOB_CODE}', 0), '') AS job_code FROM cleaned",
    ),
    "company_repair": _with(CLEANED_ALL, "SELECT ord, is_tag, new_company AS company_name FROM cleaned"),
    "value_tags": _with(
        CLEANED_ALL,
        "SELECT ord, concat_ws('|', nullif(value_tags, ''), CASE WHEN contains(activity_marks, 'HR近期来过') "
        "OR contains(activity_marks, 'HR刚刚处理简历') THEN 'HR活跃' END) AS value_tags FROM cleaned",
    ),
    "text_signals": _with(
        POSTINGS,
        "SELECT signal, count(*) AS job_count FROM (SELECT 'pay_percentile:' || CAST(ord % 100 AS VARCHAR) "
        "AS signal FROM postings UNION ALL SELECT CASE ord % 4 WHEN 0 THEN 'deadline_days:3' WHEN 1 THEN "
        "'board:HC充足榜' WHEN 2 THEN 'apply:简历直投官网' END FROM postings) WHERE signal IS NOT NULL GROUP BY 1",
    ),
    "link_fields": _with(
        f"{POSTINGS}, cards AS ({_view(views.CARD_SQL, 'postings')}), "
        f"linked AS (SELECT *, {_absolute('href')} AS link FROM cards)",
        f"SELECT card_id, link, CASE WHEN link IS NULL THEN '' ELSE {_id('link')} END AS job_id, "
        "CASE card_id % 4 WHEN 0 THEN '校招' WHEN 1 THEN '实习' WHEN 2 THEN '社招' ELSE '未知' END "
        "AS recruit_type FROM linked",
    ),
    # cleaning
    "cleaned_postings": _with(CLEANED, FLAT),
    "high_value_jobs": _with(CLEANED, FLAT + " WHERE value_tags <> ''"),
    "meaningful_jobs": _with(
        CLEANED,
        "SELECT ord, job_id, clean_title AS job_name FROM cleaned WHERE clean_title <> '未知' AND job_id <> ''",
    ),
    "cleaning_report": _with(f"{CLEANED}, {_REPORT.split(') SELECT metric')[0]})",
                             "SELECT metric" + _REPORT.split(") SELECT metric")[1]),
    "content_duplicates": _with(
        CLEANED_ALL,
        "SELECT count(*) - count(DISTINCT content_key) AS duplicate_content_warning FROM cleaned",
    ),
    "dedup_first_wins": _with(f"{POSTINGS}, {KEPT}", "SELECT ord, job_id FROM kept"),
    "dedup_content": _with(
        CLEANED_ALL, "SELECT min(ord) AS ord, content_key FROM cleaned GROUP BY content_key"
    ),
    "normalised_titles": _with(
        CLEANED_ALL,
        f"SELECT ord, {STANDARD_TITLE} AS standard_title, company_name, salary FROM cleaned",
    ),
    "union_recruit_types": _with(
        POSTINGS,
        f"SELECT ord, job_id, {_PART_NAME} AS recruit_type FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY job_id ORDER BY {_PART}, ord) AS rn FROM postings) WHERE rn = 1 OR job_id = ''",
    ),
    # analytics
    "city_salary_quantiles": _j(_quantiles("effective_city")),
    "skill_salary_quantiles": _j(_quantiles("skill", "skilled")),
    "education_salary_quantiles": _j(_quantiles("education", where="education <> ''")),
    "city_salary_histogram": _j(
        "SELECT effective_city, mid // 5000 * 5000 AS bucket, count(*) AS job_count FROM jobs "
        "WHERE mid IS NOT NULL GROUP BY 1, 2"
    ),
    "education_share": _j(_share("education")),
    "job_type_salary": _j(_share("job_type")),
    "company_type_salary": _j(_share("company_type")),
    "company_nature_salary": _j(_share("company_nature")),
    "internship_vs_regular": _j(
        "SELECT CASE WHEN grouping(effective_city) = 0 THEN 'city' WHEN grouping(company_type) = 0 "
        "THEN 'company_type' ELSE 'all' END AS scope, coalesce(effective_city, company_type, 'all') AS value, "
        f"is_internship, count(*) AS job_count, {_MEAN} AS avg_salary FROM jobs GROUP BY GROUPING SETS "
        "((is_internship), (is_internship, effective_city), (is_internship, company_type))"
    ),
    "internship_terms": _j(_terms("effective_city, company_type")),
    "internship_term_distribution": _j(
        "SELECT intern_duration, work_days_per_week, count(*) AS job_count FROM jobs WHERE is_internship GROUP BY 1, 2"
    ),
    "recruit_by_year": _j(_cube("recruit_type", "graduate_year")),
    "education_city_cube": _j(_cube("education", "effective_city")),
    "city_skill_matrix": _j(
        "SELECT effective_city AS city, skill, count(*) AS job_count FROM skilled GROUP BY 1, 2"
    ),
    "skill_jobtype_matrix": _j(
        "SELECT skill, job_type, count(*) AS job_count FROM skilled WHERE job_type <> '' GROUP BY 1, 2"
    ),
    "city_competition": _j(
        "SELECT *, CAST(rank() OVER (ORDER BY job_count DESC) AS BIGINT) AS job_rank FROM (SELECT effective_city "
        "AS city, count(*) AS job_count, count(*) FILTER (WHERE is_active) AS active_count, "
        f"{pct('count(*) FILTER (WHERE is_active)', 'count(*)')} AS active_share FROM jobs GROUP BY 1)"
    ),
    "active_companies": _j(
        "SELECT *, CAST(rank() OVER (ORDER BY active_count DESC) AS BIGINT) AS active_rank FROM (SELECT "
        "company_name, count(*) AS job_count, count(*) FILTER (WHERE is_active) AS active_count FROM jobs "
        "WHERE company_name <> '' GROUP BY 1) WHERE active_count > 0"
    ),
    "overview": _with(
        f"{JOBS}, {DASH}",
        "SELECT 'total' AS section, metric_name AS name, CAST(metric_value AS BIGINT) AS value FROM dash "
        "UNION ALL (SELECT 'skill', skill, count(*) AS n FROM skilled GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10) "
        "UNION ALL (SELECT 'city', effective_city, count(*) AS n FROM jobs GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)",
    ),
    "negotiable_by_company_type": _j(_ratio("company_type", "company_type")),
    "education_city_pivot": _j(
        "SELECT effective_city, count(*) FILTER (WHERE education = '本科') AS bachelor, count(*) FILTER "
        "(WHERE education = '硕士') AS master, count(*) FILTER (WHERE education = '博士') AS doctor "
        "FROM jobs GROUP BY 1"
    ),
    "filtered_compare": _j(
        f"SELECT effective_city, education, {_METRICS} FROM jobs WHERE effective_city IN ('北京', '上海', '深圳') "
        "AND education IN ('本科', '博士') AND (list_contains(skills, 'Java') OR list_contains(skills, 'Go')) "
        "GROUP BY 1, 2"
    ),
    "high_pay_high_favourite": _j(
        "SELECT ord, job_id, mid AS avg_monthly_salary, collection_count FROM jobs "
        "WHERE mid >= 20000 AND collection_count >= 50"
    ),
    "favourite_jobs": _j("SELECT ord, collection_count FROM jobs WHERE collection_count >= 10"),
    "hr_active_jobs": _j(
        "SELECT ord, job_name FROM jobs WHERE contains(job_desc, 'HR近期来过') OR contains(job_desc, 'HR刚刚处理简历')"
    ),
    # quality
    "quality_profile": _with(POSTINGS, _profile(["ord", *COLUMNS], "postings")),
    "quality_change": _with(
        f"{CLEANED_ALL}, before AS ({_profile(_CHANGED, 'cleaned', rate='rate_before')}), "
        f"after AS ({_profile(_CHANGED, 'cleaned', _CHANGED_TO, 'rate_after')})",
        "SELECT field, rate_before, rate_after, round(rate_after - rate_before, 2) AS change "
        "FROM before JOIN after USING (field)",
    ),
    "review_sample": _with(
        POSTINGS,
        "SELECT ord, job_name FROM postings ORDER BY md5('review' || CAST(ord AS VARCHAR)), ord LIMIT 50",
    ),
    # input and output
    "tolerant_lines": _with(
        POSTINGS,
        "SELECT ord, CASE WHEN ord % 16 > 3 THEN job_name END AS job_name, CASE WHEN ord % 16 > 3 THEN city END AS city, "
        "CASE WHEN ord % 16 > 3 THEN salary END AS salary, CASE WHEN ord % 16 > 3 THEN CAST(ord AS VARCHAR) END AS job_id, "
        "CASE WHEN ord % 16 > 3 THEN company_name END AS company_name, "
        "CASE WHEN ord % 16 = 3 THEN '{bad' END AS corrupt_line FROM postings WHERE ord % 16 > 2",
    ),
    "strict_lines": _with(
        LINES,
        "SELECT ord, "
        + ", ".join(
            f"""regexp_extract(value, '"{k}"\\s*:\\s*"([^"]*)"', 1) AS {c}"""
            for k, c in SOURCE_KEYS.items()
            if c in ("job_name", "city", "salary", "job_id", "company_name")
        )
        + " FROM text_lines WHERE trim(value) NOT IN ('', '[', ']')",
    ),
    "job_counters": _with(
        LINES,
        "SELECT 'lines_in' AS counter, count(*) AS value FROM text_lines UNION ALL SELECT 'records_out', "
        "count(*) FILTER (WHERE ord % 16 > 3) FROM text_lines UNION ALL SELECT 'parse_errors', "
        "count(*) FILTER (WHERE ord % 16 = 3) FROM text_lines UNION ALL SELECT 'matched_jobs', 0",
    ),
    "topic_messages": _with(
        POSTINGS,
        "SELECT nullif(job_id, '') AS key, job_id, job_name, company_name, salary, city FROM postings",
    ),
    "message_detail": _with(
        POSTINGS,
        'SELECT CAST(ord % 3 AS INTEGER) AS partition, ord AS "offset", job_name, company_name, '
        "coalesce(nullif(salary, ''), 'N/A') AS salary FROM postings",
    ),
    "upsert_snapshot": _with(
        POSTINGS + ", b AS (SELECT company_name AS company, count(*) AS n FROM postings WHERE o_orderdate < "
        "TIMESTAMP '1997-01-01' GROUP BY 1), d AS (SELECT company_name AS company, count(*) AS n FROM postings "
        "WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1)",
        "SELECT company, coalesce(d.n, b.n) AS job_count, CASE WHEN d.n IS NULL THEN '2026-01-01' ELSE "
        "'2026-01-02' END AS update_time FROM b FULL JOIN d USING (company)",
    ),
    "serving_city_salary": _j(
        f"SELECT city, CAST(avg_salary AS DOUBLE) AS avg_salary, min_salary, max_salary, job_count FROM "
        f"({_salary_stats('effective_city', 'city')})"
    ),
    "serving_internship": _j(
        "SELECT effective_city AS city, internship_count, CAST(avg_duration AS VARCHAR) AS avg_duration, "
        f"conversion_rate FROM ({_terms('effective_city')})"
    ),
    "export_rows": _with(
        POSTINGS,
        "SELECT " + ", ".join(f'{c} AS "{k}"' for k, c in SOURCE_KEYS.items() if c in EXPORT_COLUMNS)
        + " FROM postings",
    ),
    "page_links": "WITH " + _page_links("pages", '[^"]*'),
    "listing_links": f"WITH {POSTINGS}, listing AS ({_view(views.PAGE_SQL, 'postings')}), "
    + _page_links("listing", '[^"]*/jobs/detail/[0-9]+[^"]*'),
    "card_fields": _with(_parsed_cards(), "SELECT * FROM judged"),
    "rejected_cards": _with(
        _parsed_cards(),
        "SELECT rejection AS reason, count(*) AS card_count FROM judged WHERE rejection IS NOT NULL GROUP BY 1",
    ),
    # streams
    "stream_landing": _j(
        f"SELECT '20260102' AS dt, effective_city AS city, count(*) AS job_count, {_MEAN} AS avg_salary "
        "FROM jobs GROUP BY 2"
    ),
    "stream_dedup": "SELECT DISTINCT user_id FROM events",
    "partition_counts": (
        "SELECT CAST(user_id % 3 AS INTEGER) AS partition, count(*) AS message_count FROM events GROUP BY 1"
    ),
}

ORACLES["all_skill_rollups"] = _j(
    f"SELECT skill, count(*) AS count, {_MEAN} AS avg_salary, min(CASE WHEN mid IS NOT NULL THEN min_salary END) "
    "AS min_salary, max(CASE WHEN mid IS NOT NULL THEN max_salary END) AS max_salary, count(mid) AS job_count, "
    "CAST(sum(collection_count) FILTER (WHERE is_high) AS BIGINT) AS total_collection, "
    "count(*) FILTER (WHERE is_high) AS high_count FROM skilled GROUP BY 1"
)
ORACLES["json_files"] = _with(POSTINGS, f"SELECT {', '.join(COLUMNS)} FROM postings")
ORACLES["json_array"] = ORACLES["json_files"]
ORACLES["high_value_file"] = _with(
    CLEANED, f"SELECT ord, job_id, collection_count FROM ({FLAT} WHERE value_tags <> '')"
)
ORACLES["report_file"] = ORACLES["cleaning_report"]
ORACLES["csv_file"] = ORACLES["export_rows"]
ORACLES["tsv_file"] = ORACLES["city_job_count"]
ORACLES["taken_messages"] = _with(POSTINGS, "SELECT least(count(*), 100) AS message_count FROM postings")
ORACLES["line_city_count"] = _with(
    POSTINGS, "SELECT city, count(*) AS job_count FROM postings WHERE ord % 16 > 3 GROUP BY 1"
)
ORACLES["repaired_values"] = _with(
    POSTINGS,
    "SELECT ord, CASE WHEN ord % 3 < 2 THEN '某有限公司' ELSE company_name END AS company_name, "
    "CASE ord % 3 WHEN 0 THEN '15-25K' WHEN 1 THEN '20-30K' ELSE '' END AS salary FROM postings",
)
ORACLES["tapped_messages"] = "SELECT event_type AS value, count(*) AS message_count FROM events GROUP BY 1"

# serving table -> query that holds its rows
_SERVED = {
    **{t: t for t in SERVING if t in ORACLES}, "internship_stats": "serving_internship",
    "high_collection_jobs": "high_collection_salary", "active_jobs_stats": "active_jobs",
    "negotiable_ratio_stats": "negotiable_ratio", "activity_salary_comparison": "activity_salary",
}
ORACLES["serving_refresh"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, {contract.key} AS key, '{measure}' AS measure, "
    f"CAST({measure} AS DOUBLE) AS value FROM ({ORACLES[_SERVED[table]]})"
    for table, contract in SERVING.items() for measure, _ in contract.measures
)
ORACLES["daily_refresh"] = ORACLES["serving_refresh"]
ORACLES["city_salary_sketch"] = _j(
    "SELECT effective_city, unnest(['p25', 'p50', 'p75', 'p90']) AS quantile, job_count, true AS within_bound FROM "
    "(SELECT effective_city, count(*) AS job_count FROM jobs WHERE mid IS NOT NULL GROUP BY 1)"
)
ORACLES["cleaning_run"] = " UNION ALL ".join([
    f"SELECT 'cleaned' AS output, CAST(ord AS VARCHAR) AS name, collection_count AS value FROM ({ORACLES['cleaned_postings']})",
    f"SELECT 'high_value', CAST(ord AS VARCHAR), collection_count FROM ({ORACLES['high_value_file']})",
    f"SELECT 'report', metric, value FROM ({ORACLES['cleaning_report']})",
])
ORACLES["stream_dedup_table"] = ORACLES["stream_dedup"]
ORACLES["rolled_landing"] = (
    "SELECT '20260102' AS dt, event_type AS value, count(*) AS message_count FROM events GROUP BY 2"
)
ORACLES["stream_totals"] = "SELECT count(*) AS rows FROM events"
_ROUGH = (
    "rough AS (SELECT ord, city AS c, job_name || CASE ord % 4 WHEN 0 THEN '-武汉' WHEN 1 THEN '-某地' ELSE '' END AS n, "
    "CASE WHEN ord % 3 = 0 THEN '' ELSE salary END AS s, job_desc || CASE WHEN ord % 2 = 0 THEN chr(10) || "
    "'薪资 20-40K·17薪' ELSE '' END AS d FROM postings), named AS (SELECT *, CASE WHEN trim(n) = '' OR "
    "contains(n, '为你推荐') THEN '未知' ELSE trim(n) END AS clean_title FROM rough), "
    f"titled AS (SELECT *, {STANDARD_TITLE} AS t FROM named)"
)
_CATEGORY = "CASE " + " ".join(
    f"WHEN {any_('upper(t)', [w.upper() for w in words])} THEN '{name}'" for name, words in V.JOB_FAMILIES.items()
) + " ELSE '未知' END"
ORACLES["filled_from_text"] = _with(
    f"{POSTINGS}, {_ROUGH}",
    "SELECT ord, CASE WHEN trim(c) <> '' THEN trim(c) ELSE regexp_extract(n, "
    f"'-({'|'.join(V.DESC_CITIES)})$', 1) END AS city, CASE WHEN trim(s) <> '' THEN trim(s) ELSE "
    "regexp_extract(d, '[0-9]+-[0-9]+K·[0-9]+薪', 0) END AS salary, " + _CATEGORY + " AS job_category FROM titled",
)
ORACLES["well_formed_jobs"] = _with(
    f"{POSTINGS}, odd AS (SELECT ord, job_name, CASE WHEN ord % 11 = 0 THEN 'J-' || job_id ELSE job_id END AS job_id "
    "FROM postings), first AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ord) AS rn FROM odd)",
    "SELECT ord, job_id FROM first WHERE rn = 1 AND regexp_full_match(job_id, '[0-9]+') AND trim(job_name) <> '' "
    "AND NOT contains(job_name, '为你推荐')",
)
