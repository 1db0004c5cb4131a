"""DuckDB oracle SQL for the correctness check.

DuckDB's regex engine (RE2) has no lookaround and an ASCII-only ``\\b``, so the
PostgreSQL rules are rewritten for it: every top-level alternative gets its word
boundaries as explicit neighbour classes (``(?:^|[^word])`` before,
``(?:[^word]|$)`` after, or a word character when the pattern itself ends in a
non-word character such as ``+`` or ``%``). That is exact for "does it match" and for
the first captured group.
"""

from __future__ import annotations

from hirelake.functions.regex import PG_SPACE_CHARS, _bracket_end, _group_end, _split_top
from hirelake.operators import classify as C
from hirelake.operators import salary as S
from hirelake.plans.postings import oracle_postings_sql
from hirelake.sources.taxonomy import taxonomy_rows

W = r"[\pL\p{Nd}\p{Nl}\pM\p{Pc}]"
NW = r"[^\pL\p{Nd}\p{Nl}\pM\p{Pc}]"
LEAD_W = f"(?:^|{NW})"     # a word starts here
TRAIL_W = f"(?:{NW}|$)"    # a word ends here


def _body_to_re2(body: str) -> str:
    out, i = [], 0
    while i < len(body):
        c = body[i]
        if c == "[":
            end = _bracket_end(body, i)
            out.append(body[i:end].replace(r"\s", PG_SPACE_CHARS))
            i = end
            continue
        if body.startswith("(?=", i):
            end = _group_end(body, i)
            inner = body[i + 3:end - 1]
            out.append("(?:" + _body_to_re2(inner) + ")")
            i = end
            continue
        if body.startswith("(?<!", i):
            end = _group_end(body, i)
            inner = body[i + 4:end - 1]
            if inner != r"\w":
                raise ValueError(f"unsupported lookbehind {inner!r}")
            out.append(LEAD_W)
            i = end
            continue
        if c == "\\":
            e = body[i + 1]
            out.append({"b": r"\x08", "s": "[" + PG_SPACE_CHARS + "]", "w": W, "W": NW,
                        "y": ""}.get(e, c + e))
            i += 2
            continue
        out.append(c)
        i += 1
    return "".join(out)


def _is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _first_char(body: str) -> str:
    return body[1] if body.startswith("\\") else body[0]


def _alts(p: str, lead: bool = False, trail: bool = False) -> list[tuple[str, bool, bool]]:
    parts = _split_top(p)
    if len(parts) > 1:
        return [a for part in parts for a in _alts(part, lead, trail)]
    if p.startswith(r"\y"):
        p, lead = p[2:], True
    if p.endswith(r"\y"):
        p, trail = p[:-2], True
    if p.startswith("(") and not p.startswith(("(?=", "(?!", "(?<")) and _group_end(p, 0) == len(p):
        inner = p[3:-1] if p.startswith("(?:") else p[1:-1]
        return [a for part in _split_top(inner) for a in _alts(part, lead, trail)]
    return [(p, lead, trail)]


def _alt_to_re2(body: str, lead: bool, trail: bool) -> str:
    pre = ""
    if lead:
        pre = LEAD_W if _is_word_char(_first_char(body)) else W
    if trail and body.endswith("\\.?"):
        core = _body_to_re2(body[:-3])
        return pre + core + f"(?:\\.{W}|{TRAIL_W})"
    post = ""
    if trail:
        last = body[-1]
        escaped = len(body) >= 2 and body[-2] == "\\"
        post = TRAIL_W if (_is_word_char(last) and not escaped) else W
    return pre + _body_to_re2(body) + post


def re2_ci(pattern: str) -> str:
    """RE2 pattern that matches where PostgreSQL ``~* pattern`` matches."""
    return "(?is)" + "|".join(_alt_to_re2(*a) for a in _alts(pattern))


def re2_capture(pattern: str) -> str:
    """RE2 for ``\\y(a|b)\\y`` patterns, keeping group 1 (case-sensitive)."""
    assert pattern.startswith(r"\y(") and pattern.endswith(r")\y"), pattern
    inner = pattern[3:-3]
    return "(?s)" + LEAD_W + "(" + _body_to_re2(inner) + ")" + TRAIL_W


def re2_cs(pattern: str) -> str:
    """RE2 for a case-sensitive pattern without word boundaries."""
    return "(?s)" + _body_to_re2(pattern)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def match_ci(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {q(re2_ci(pattern))})"


def rules_sql(col: str, table, default: str | None) -> str:
    whens = " ".join(f"WHEN {match_ci(col, p)} THEN {q(label)}" for p, label in table)
    return f"CASE {whens} ELSE {default if default is not None else 'NULL'} END"


def _amount(num: str, k: str) -> str:
    return (f"CASE WHEN {num} IS NULL THEN NULL "
            f"WHEN coalesce({k} = 'k', false) THEN "
            f"TRY(TRY_CAST(replace({num}, ',', '.') AS DECIMAL(38,4)) * {S.THOUSAND}) "
            f"ELSE TRY_CAST(replace(replace({num}, '.', ''), ',', '') AS DECIMAL(38,4)) END")


def _yearly(amount: str) -> str:
    return (f"CAST(CASE WHEN salary_period = 'monthly' THEN TRY({amount} * {S.MONTHLY_FACTOR}) "
            f"WHEN salary_period = 'hourly' THEN TRY({amount} * {S.HOURLY_FACTOR}) "
            f"ELSE {amount} END AS DECIMAL(38,4))")


def _floor(col: str) -> str:
    return f"CASE WHEN {col} < {S.YEARLY_FLOOR} THEN NULL ELSE {col} END"


def silver_ctes() -> str:
    """CTEs ``postings``, ``base``, ``parsed``, ``silver`` (all silver columns)."""
    space = "[" + PG_SPACE_CHARS + "]"
    pre, suf = q(re2_cs(S.SALARY_PREFIX)), q(re2_cs(S.SALARY_SUFFIX))
    emp_fields = " ".join(
        f"WHEN source = {q(src)} AND {'contract_time' if f == 'contract_time' else 'jtype'} "
        f"ILIKE {q(pat)} THEN {q(label)}" for src, f, pat, label in C.EMPLOYMENT_FIELD_RULES)
    emp_text = " ".join(f"WHEN {match_ci('job_description', p)} THEN {q(l)}"
                        for p, l in C.EMPLOYMENT_TEXT_RULES)
    remote_text = " ".join(f"WHEN {match_ci('job_description', p)} THEN {q(l)}"
                           for p, l in C.REMOTE_TEXT_RULES)
    level_title = " ".join(f"WHEN {match_ci('lower(job_title)', p)} THEN {q(l)}"
                           for p, l in C.LEVEL_TITLE_RULES)
    level_types = " ".join(f"WHEN source = 'arbeitnow' AND {match_ci('job_types_text', p)} THEN {q(l)}"
                           for p, l in C.LEVEL_JOB_TYPES_RULES)
    currency = " ".join(f"WHEN raw_currency IN ({', '.join(q(t) for t in toks)}) THEN {q(l)}"
                        for toks, l in C.CURRENCY_LABELS)
    country_only = " OR ".join(f"trim(location) ILIKE {q(n)}" for n in C.COUNTRY_ONLY_LOCATIONS)
    geo = " OR ".join(f"job_description ILIKE {q(w)}" for w in C.TIER_GEO_WORDS)
    geo_countries = ", ".join(q(c) for c in C.TIER_GEO_COUNTRIES)
    g = lambda n, i: f"NULLIF(regexp_extract(salary_text, {n}, {i}), '')"
    return f"""
    postings AS ({oracle_postings_sql()}),
    base AS (
      SELECT job_id, source, keyword, extracted_at, title AS job_title, company AS company_name,
             regexp_replace(replace(regexp_replace(regexp_replace(body, '<[^>]+>', ' ', 'g'),
                 '[\\r\\n\\t]+', ' ', 'g'), '&nbsp;', ' '), {q(space + '{2,}')}, ' ', 'g')
                 AS job_description,
             CASE WHEN source = 'jooble' THEN body END AS snippet,
             lower(trim(concat(CASE WHEN source <> 'jooble' THEN body END, ' ',
                               CASE WHEN source = 'jooble' THEN body END, ' ', salary)))
                 AS salary_text,
             CASE WHEN source = 'adzuna' THEN area[1] END AS area_first,
             CASE WHEN source = 'adzuna' THEN area[-1] END AS area_last,
             CASE WHEN source = 'arbeitnow' THEN location END AS location,
             'https://jobs.example/' || doc_id AS redirect_url,
             posted_at AS job_posted_at,
             CASE WHEN source = 'adzuna' THEN contract_time END AS contract_time,
             CASE WHEN source = 'jooble' THEN jtype END AS jtype,
             CASE WHEN source = 'arbeitnow' THEN remote END AS remote,
             CASE WHEN source = 'arbeitnow' THEN CAST(to_json(job_types) AS VARCHAR) END AS job_types_text,
             CAST(CASE WHEN source = 'adzuna' THEN salary_min END AS DECIMAL(38,4)) AS payload_min,
             CAST(CASE WHEN source = 'adzuna' THEN salary_max END AS DECIMAL(38,4)) AS payload_max
      FROM postings
    ),
    parsed AS (
      SELECT *,
        CASE source
          WHEN 'adzuna' THEN {rules_sql('area_first', C.COUNTRY_AREA_RULES, 'area_first')}
          WHEN 'jooble' THEN {rules_sql('snippet', C.COUNTRY_SNIPPET_RULES, q(C.UNKNOWN_COUNTRY))}
          WHEN 'arbeitnow' THEN {rules_sql('location', C.COUNTRY_LOCATION_RULES, q(C.UNKNOWN_COUNTRY))}
          ELSE {q(C.UNKNOWN_COUNTRY)} END AS job_country,
        CASE source
          WHEN 'adzuna' THEN CASE WHEN area_first = area_last THEN NULL ELSE area_last END
          WHEN 'jooble' THEN NULLIF(regexp_extract(lower(snippet),
                                  {q(re2_capture(C.JOOBLE_CITY_PATTERN))}, 1), '')
          WHEN 'arbeitnow' THEN CASE WHEN {country_only} THEN NULL
                                     ELSE trim(split_part(location, ',', 1)) END
          END AS job_city,
        {rules_sql('salary_text', C.SALARY_PERIOD_RULES, q('yearly'))} AS salary_period,
        CASE {emp_fields} {emp_text} ELSE {q(C.NOT_SPECIFIED)} END AS employment_type,
        CASE WHEN source = 'arbeitnow' AND remote = true THEN 'yes'
             WHEN source = 'arbeitnow' AND remote = false THEN 'no'
             {remote_text} ELSE {q(C.NOT_SPECIFIED)} END AS is_remote,
        CASE {level_title} {level_types} ELSE {q(C.NOT_SPECIFIED)} END AS position_level,
        {rules_sql('job_description', C.LANGUAGE_RULES, q(C.NOT_SPECIFIED))} AS language_requirement,
        {g(pre, 0)} AS pre0, {g(pre, 1)} AS pre1, {g(pre, 2)} AS pre2, {g(pre, 3)} AS pre3,
        {g(pre, 4)} AS pre4, {g(pre, 5)} AS pre5,
        {g(suf, 0)} AS suf0, {g(suf, 1)} AS suf1, {g(suf, 2)} AS suf2, {g(suf, 3)} AS suf3,
        {g(suf, 4)} AS suf4, {g(suf, 5)} AS suf5
      FROM base
    ),
    amounts AS (
      SELECT *,
        CASE WHEN pre0 IS NOT NULL THEN pre1 WHEN suf0 IS NOT NULL THEN suf5
             ELSE {q(S.DEFAULT_RAW_CURRENCY)} END AS raw_currency,
        CASE WHEN pre0 IS NOT NULL AND pre2 IS NOT NULL THEN {_amount('pre2', 'pre3')}
             WHEN suf0 IS NOT NULL AND suf1 IS NOT NULL THEN {_amount('suf1', 'suf2')} END AS regex_min,
        CASE WHEN pre0 IS NOT NULL AND pre4 IS NOT NULL THEN {_amount('pre4', 'pre5')}
             WHEN suf0 IS NOT NULL AND suf3 IS NOT NULL THEN {_amount('suf3', 'suf4')} END AS regex_max
      FROM parsed
    ),
    normalized AS (
      SELECT *,
        CAST(coalesce(payload_min, regex_min) AS DECIMAL(38,4)) AS base_salary_min,
        CAST(coalesce(payload_max, regex_max) AS DECIMAL(38,4)) AS base_salary_max
      FROM amounts
    ),
    silver AS (
      SELECT job_id, source, keyword, extracted_at AS extracted_at_utc, job_title, company_name,
             job_description, job_country, job_city, redirect_url,
             job_posted_at AS job_posted_at_utc,
             (base_salary_min IS NOT NULL AND base_salary_max IS NOT NULL) AS salary_is_range,
             CAST({_floor(_yearly('base_salary_min'))} AS DECIMAL(38,4)) AS salary_min_yearly,
             CAST({_floor(_yearly('base_salary_max'))} AS DECIMAL(38,4)) AS salary_max_yearly,
             CASE {currency} ELSE 'EUR' END AS normalized_currency,
             employment_type, is_remote, position_level, language_requirement,
             CASE WHEN job_description IS NULL THEN {q(C.TIER_MISSING)}
                  WHEN length(job_description) < {C.TIER_SHORT_CHARS} THEN {q(C.TIER_SHORT)}
                  WHEN {geo} OR job_country IN ({geo_countries}) THEN {q(C.TIER_GEO)}
                  WHEN length(job_description) < {C.TIER_PARTIAL_CHARS} THEN {q(C.TIER_PARTIAL)}
                  ELSE {q(C.TIER_VALID)} END AS description_quality_tier,
             salary_period, raw_currency, regex_min, regex_max, base_salary_min, base_salary_max
      FROM normalized
    )"""


def skill_hits_sql(source: str) -> str:
    """One branch per taxonomy row with a constant pattern (compiled once)."""
    return "\n      UNION ALL ".join(
        f"SELECT job_id, {q(c)} AS skill_category, {q(n)} AS skill_name FROM {source} "
        f"WHERE regexp_matches(searchable_text, {q(re2_ci(p))})"
        for c, n, p in taxonomy_rows())


def gold_ctes() -> str:
    """silver CTEs + skills, fact, dimensions and bridge."""
    from hirelake.functions.keys import SURROGATE_NULL
    from hirelake.plans.gold import DATE_END, DATE_START, MONTH_NAME_WIDTH
    return silver_ctes() + f""",
    searchable AS (
      SELECT job_id, concat(job_title, ' ', job_description) AS searchable_text
      FROM silver WHERE job_description IS NOT NULL AND job_description <> ''
    ),
    job_skills AS (
      SELECT DISTINCT job_id, skill_category, skill_name FROM (
      {skill_hits_sql('searchable')})
    ),
    dim_companies AS (
      SELECT md5(company_name) AS company_id, company_name
      FROM (SELECT DISTINCT company_name FROM silver WHERE company_name IS NOT NULL)
    ),
    dim_skills AS (
      SELECT md5(skill_name) AS skill_id, skill_category, skill_name
      FROM (SELECT DISTINCT skill_name, skill_category FROM job_skills)
    ),
    bridge AS (SELECT job_id, md5(skill_name) AS skill_id FROM job_skills),
    fact AS (
      SELECT job_id,
             md5(coalesce(company_name, {q(SURROGATE_NULL)})) AS company_id,
             CAST(strftime(job_posted_at_utc, '%Y%m%d') AS INTEGER) AS date_id,
             keyword AS search_role, job_title, job_posted_at_utc,
             job_country AS country, job_city AS city, source AS platform_name,
             position_level, employment_type, is_remote, salary_min_yearly, salary_max_yearly,
             CAST(CASE WHEN salary_min_yearly IS NOT NULL AND salary_max_yearly IS NOT NULL
                       THEN (salary_min_yearly + salary_max_yearly) / 2 END AS DECIMAL(38,4))
                 AS salary_midpoint_yearly
      FROM silver WHERE description_quality_tier <> {q(C.TIER_MISSING)}
    ),
    dim_date AS (
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
             CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
             rpad(strftime(d, '%B'), {MONTH_NAME_WIDTH}, ' ') AS month_name,
             CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) AS INTEGER) AS day_of_week,
             isodow(d) IN (6, 7) AS is_weekend
      FROM generate_series(DATE '{DATE_START}', DATE '{DATE_END}', INTERVAL 1 DAY) AS g(d)
    )"""
