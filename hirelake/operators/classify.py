"""Rule classifiers of the silver layer (country, city, employment, remote, level,
language, currency, salary period, description quality).

Each classifier is an ordered rule table: the first matching rule wins and NULL text
matches nothing. Patterns are PostgreSQL regular expressions (see
``hirelake.functions.regex``) matched case-insensitively unless noted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.regex import first_group, holds
from hirelake.functions.rules import classify_rules, regex_rules
from hirelake.functions.text import before_first_comma

# ----------------------------------------------------------------------------------
# Rule tables of the job-postings warehouse, in rule order. Results
# must equal the original pipeline's, so patterns, labels and thresholds are kept
# exactly as written there.
# ----------------------------------------------------------------------------------

COUNTRY_AREA_RULES = [  # adzuna, first element of location.area
    (r"(austria|österreich|osterreich|\yat\y)", "AT"),
    (r"(germany|deutschland|\yde\y)", "DE"),
    (r"(switzerland|schweiz|suisse|\ych\y)", "CH"),
]

COUNTRY_SNIPPET_RULES = [  # jooble, snippet text
    (r"(india|bangalore|hyderabad|pune|mumbai|\bin\b)", "IN"),
    (r"(usa|texas|\btx\b|houston|new york|\bny\b|california|\bca\b)", "US"),
    (r"(austria|österreich|osterreich|\yat\y|vienna|wien|graz|linz|salzburg|innsbruck)", "AT"),
    (r"(germany|deutschland|\yde\y|berlin|munich|münchen|hamburg|frankfurt|stuttgart)", "DE"),
    (r"(switzerland|schweiz|suisse|\ych\y|zurich|zürich|geneva|genf|basel|bern)", "CH"),
]

COUNTRY_LOCATION_RULES = [  # arbeitnow, location text
    (r"(austria|österreich|osterreich|\yat\y|vienna|wien|graz|linz|salzburg|innsbruck)", "AT"),
    (r"(germany|deutschland|\yde\y|berlin|munich|münchen|hamburg|frankfurt|stuttgart|leipzig|cologne)", "DE"),
    (r"(switzerland|schweiz|suisse|\ych\y|zurich|zürich|geneva|genf|basel|bern)", "CH"),
]

JOOBLE_CITY_PATTERN = r"\y(wien|vienna|graz|linz|salzburg|innsbruck|berlin|munich|münchen|hamburg|frankfurt)\y"
COUNTRY_ONLY_LOCATIONS = ["Austria", "Germany"]  # arbeitnow locations that name no city (ILIKE)

EMPLOYMENT_FIELD_RULES = [  # (source, payload field, ILIKE pattern, label)
    ("adzuna", "contract_time", "%full_time%", "vollzeit"),
    ("adzuna", "contract_time", "%part_time%", "teilzeit"),
    ("jooble", "type", "%Full-time%", "vollzeit"),
    ("jooble", "type", "%Part-time%", "teilzeit"),
]

EMPLOYMENT_TEXT_RULES = [  # cleaned description
    (r"full/\s*part[- ]time:\s*full[- ]time", "vollzeit"),
    (r"full/\s*part[- ]time:\s*part[- ]time", "teilzeit"),
    (r"\y(vollzeit|full[- ]time|100%)\y", "vollzeit"),
    (r"\y(teilzeit|part[- ]time)\y", "teilzeit"),
    (r"\y(minijob|geringfügig)\y", "minijob"),
]

REMOTE_TEXT_RULES = [  # cleaned description, after the arbeitnow boolean
    (r"\y(remote|home[- ]?office|work from home|wfh)\y", "yes"),
    (r"\y(vor ort|on[- ]?site|präsenz|office[- ]based)\y", "no"),
]

LEVEL_TITLE_RULES = [  # lower-cased title
    (r"\y(senior|sr\.?|lead|principal|head|manager)\y", "senior"),
    (r"\y(junior|jr\.?|berufseinsteiger|entry[- ]level)\y", "junior"),
    (r"\y(werkstudent|working student)\y", "werkstudent"),
    (r"\y(praktikum|intern|praktikant|internship)\y", "internship"),
    (r"\y(trainee)\y", "trainee"),
    (r"\y(medior|mid[- ]level|regular)\y", "middle"),
]

LEVEL_JOB_TYPES_RULES = [  # arbeitnow job_types array text
    (r"\y(senior|lead|principal|head|manager)\y", "senior"),
    (r"\y(berufserfahren|professional|experienced)\y", "middle"),
    (r"\y(junior|berufseinsteiger|entry[- ]level)\y", "junior"),
]

LANGUAGE_RULES = [  # cleaned description
    (r"\y(english only|working language.{0,10}english|no german required)\y", "english_only"),
    (r"\y(muttersprache|verhandlungssicher|c1|c2|fließend deutsch|german.{0,15}required)\y", "german_fluent"),
    (r"\y(b1|b2|grundkenntnisse|german.{0,15}plus|german.{0,15}advantage|nice to have)\y", "german_basic"),
]

SALARY_PERIOD_RULES = [  # lower-cased salary text
    (r"(monatlich|monthly|per month|/monat)", "monthly"),
    (r"(stündlich|hourly|per hour|/stunde|/hr)", "hourly"),
]

CURRENCY_LABELS = [  # raw currency token -> label; anything else is EUR
    (("€", "eur", "brutto"), "EUR"),
    (("$", "usd"), "USD"),
    (("£", "gbp"), "GBP"),
]

NOT_SPECIFIED = "not_specified"
UNKNOWN_COUNTRY = "Unknown"
TIER_MISSING = "Tier 3 - Missing Description"
TIER_SHORT = "Tier 3 - Too Short"
TIER_GEO = "Tier 3 - Geo Mismatch"
TIER_PARTIAL = "Tier 2 - Partial"
TIER_VALID = "Tier 1 - Valid"
TIER_SHORT_CHARS = 150
TIER_PARTIAL_CHARS = 500
TIER_GEO_WORDS = ["%India%", "%Bangalore%", "%Hyderabad%"]  # ILIKE
TIER_GEO_COUNTRIES = ["IN", "US"]
WEEKEND_ISO_DAYS = [6, 7]

# ----------------------------------------------------------------------------------


def job_country(source: Column, area_first: Column, snippet: Column | str, location: Column,
                snippet_lc: Column | str | None = None,
                snippet_hazard: Column | str | None = None) -> Column:
    """Country code per source; adzuna falls back to the raw area text."""
    adzuna = regex_rules(area_first, COUNTRY_AREA_RULES, area_first)
    jooble = regex_rules(snippet, COUNTRY_SNIPPET_RULES, UNKNOWN_COUNTRY, lowered=snippet_lc,
                         hazard=snippet_hazard)
    arbeit = regex_rules(location, COUNTRY_LOCATION_RULES, UNKNOWN_COUNTRY)
    return (F.when(source == "adzuna", adzuna)
            .when(source == "jooble", jooble)
            .when(source == "arbeitnow", arbeit)
            .otherwise(F.lit(UNKNOWN_COUNTRY)))


def job_city(source: Column, area_first: Column, area_last: Column, snippet: Column,
             location: Column, snippet_lc: Column | None = None) -> Column:
    """City per source: last area element, a city word of the snippet, or the text
    before the first comma of the location."""
    snippet_lc = snippet_lc if snippet_lc is not None else F.lower(snippet)
    # A case-sensitive match on the lower-cased snippet finds a city exactly when the
    # case-insensitive test on the snippet does, so one regex serves as test and value.
    jooble_city = first_group(snippet_lc, JOOBLE_CITY_PATTERN, 1)
    loc = F.trim(location)
    country_only = None
    for name in COUNTRY_ONLY_LOCATIONS:
        c = loc.ilike(name)
        country_only = c if country_only is None else (country_only | c)
    return (F.when(source == "adzuna",
                   F.when(area_first == area_last, F.lit(None).cast("string")).otherwise(area_last))
            .when(source == "jooble", jooble_city)
            .when(source == "arbeitnow",
                  F.when(country_only, F.lit(None).cast("string"))
                  .otherwise(before_first_comma(location))))


def employment_type(source: Column, contract_time: Column, jtype: Column,
                    description: Column | str, desc_lc: Column | str | None = None,
                    desc_hazard: Column | str | None = None) -> Column:
    fields = {"contract_time": contract_time, "type": jtype}
    field_rules = [((source == src) & fields[f].ilike(pat), label)
                   for src, f, pat, label in EMPLOYMENT_FIELD_RULES]
    text = regex_rules(description, EMPLOYMENT_TEXT_RULES, NOT_SPECIFIED, desc_lc, desc_hazard)
    return classify_rules(field_rules, text)


def is_remote(source: Column, remote_flag: Column, description: Column | str,
              desc_lc: Column | str | None = None, desc_hazard: Column | str | None = None) -> Column:
    arbeit = source == "arbeitnow"
    text = regex_rules(description, REMOTE_TEXT_RULES, NOT_SPECIFIED, desc_lc, desc_hazard)
    return classify_rules([(arbeit & (remote_flag == F.lit(True)), "yes"),
                           (arbeit & (remote_flag == F.lit(False)), "no")], text)


def position_level(source: Column, title: Column, job_types_text: Column) -> Column:
    title_lc = F.lower(title)
    title_rules = regex_rules(title_lc, LEVEL_TITLE_RULES, None, lowered=title_lc)
    types_rules = F.when(source == "arbeitnow",
                         regex_rules(job_types_text, LEVEL_JOB_TYPES_RULES, None))
    return F.coalesce(title_rules, types_rules, F.lit(NOT_SPECIFIED))


def language_requirement(description: Column | str, desc_lc: Column | str | None = None,
                         desc_hazard: Column | str | None = None) -> Column:
    return regex_rules(description, LANGUAGE_RULES, NOT_SPECIFIED, desc_lc, desc_hazard)


def salary_period(salary_text_lc: Column | str, hazard: Column | str | None = None) -> Column:
    return regex_rules(salary_text_lc, SALARY_PERIOD_RULES, "yearly", lowered=salary_text_lc,
                       hazard=hazard)


def normalized_currency(raw_currency: Column) -> Column:
    return classify_rules(((raw_currency.isin(*tokens), label) for tokens, label in CURRENCY_LABELS),
                          "EUR")


def description_quality_tier(description: Column, country: Column, desc_lc: Column | None = None) -> Column:
    # characters are counted up to the larger limit only
    n = F.length(F.left(description, F.lit(max(TIER_SHORT_CHARS, TIER_PARTIAL_CHARS))))
    desc_lc = desc_lc if desc_lc is not None else F.lower(description)
    geo = None
    for w in TIER_GEO_WORDS:
        c = holds(desc_lc, w.lower().strip("%"))
        geo = c if geo is None else (geo | c)
    geo = geo | country.isin(*TIER_GEO_COUNTRIES)
    return (F.when(description.isNull(), F.lit(TIER_MISSING))
            .when(n < TIER_SHORT_CHARS, F.lit(TIER_SHORT))
            .when(geo, F.lit(TIER_GEO))
            .when(n < TIER_PARTIAL_CHARS, F.lit(TIER_PARTIAL))
            .otherwise(F.lit(TIER_VALID)))


def is_weekend(iso_day: Column) -> Column:
    return iso_day.isin(*WEEKEND_ISO_DAYS)
