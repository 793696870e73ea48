"""Names, orders and limits that results have to agree on."""

# ---- fixed values: snapshot source -----------------------------------------
EXPECTED_SOURCE = "nofluffjobs"
POSTING_PAGE_PREFIX = "https://nofluffjobs.com/pl/job/"
REQUIREMENTS_ELEMENT_ID = "posting-requirements"
KEYWORD_CSS_CLASS = "btn"

# ---- fixed values: cleaning -------------------------------------------------
UNWANTED_COLUMNS = [
    "renewed",
    "logo",
    "regions",
    "flavors",
    "topInSearch",
    "highlighted",
    "onlineInterviewAvailable",
    "referralBonus",
    "referralBonusCurrency",
]
LOWER_COLUMNS = ["technology"]
REPLACED_VALUES = {
    "node.js": "node",
    "angular": "javascript",
    "react": "javascript",
}
SPLIT_COLUMNS = ["category"]
TITLE_COLUMNS = ["category"]
CAPITALIZED_COLUMNS = ["technology", "contract_type"]
SPECIAL_NAMES = {
    ".net": ".Net",
    "aws": "AWS",
    "ios": "iOS",
    "javascript": "JavaScript",
    "php": "PHP",
    "sql": "SQL",
    "b2b": "B2B",
}
MISSING_TEXTS = ["", "NaN", "Nan", "nan"]
KEPT_CURRENCY = "PLN"
KEPT_COUNTRIES = ["Polska"]

# ---- fixed values: served columns -------------------------------------------
DOCUMENT_COLUMNS = [
    "id",
    "name",
    "posted",
    "title",
    "technology",
    "category",
    "url",
    "remote",
    "contract_type",
    "salary_min",
    "salary_max",
    "salary_mean",
    "city",
    "seniority",
]
POSTINGS_COLUMNS = [
    "id",
    "name",
    "posted",
    "title",
    "technology",
    "category",
    "url",
    "remote",
]
SALARIES_COLUMNS = [
    "id",
    "contract_type",
    "salary_min",
    "salary_max",
    "salary_mean",
]
LOCATIONS_COLUMNS = ["id", "city", "lat", "lon"]
SENIORITIES_COLUMNS = ["id", "seniority"]

# ---- fixed values: insights -------------------------------------------------
SENIORITY_ORDER = {
    "Trainee": 0,
    "Junior": 1,
    "Mid": 2,
    "Senior": 3,
    "Expert": 4,
}
SHARE_TOP_N = 12
FLOW_TOP_N = 12
FLOW_MIN_COUNT = 12
CITY_TOP_N = 15
CITY_MIN_JOBS = 25
DISTRIBUTION_TOP_N = 8
DISTRIBUTION_SENIORITIES = ["Junior", "Mid", "Senior"]
DISTRIBUTION_CONTRACTS = ["B2B", "Permanent"]
DISTRIBUTION_MIN_GROUP = 3
TECHNOLOGY_SALARY_LIMIT = 35000
CONTRACT_SALARY_LIMIT = 40000
HISTOGRAM_SALARY_LIMIT = 40000
