"""Fixed values that results depend on. Nothing here is logic."""

# Columns of the award register that matching reads.
AWARD_COLUMNS = [
    "source", "source_record_id", "beneficiary_name", "country", "amount_eur", "amount_gge_eur", "year", "description", "original_columns",
    "financial_instrument_class", "flow_stage_group", "flow_stage", "fiscal_source_type", "is_primary_record", "entity_name_raw", "entity_name_clean",
    "entity_id", "entity_type", "sector_description", "nace_2digit", "exclude_reason", "programme", "fund",
]

# Words that say where, not who.
COUNTRY_TOKENS = (
    "germany france italy spain poland romania netherlands belgium czech austria sweden hungary portugal greece finland denmark ireland croatia slovakia slovenia "
    "lithuania latvia estonia luxembourg malta cyprus bulgaria europe european central eastern western northern united kingdom uk global international italia italiana "
    "italiano hungaria hungaro deutschland deutsche deutscher francais francaise espana espanol portuguesa ceska cesky polska polski romana slovensko slovensky nederland "
    "belgique osterreich schweiz suisse wroclaw brandenburg sachsen navarra saarland"
).split()

# Words of business and of legal forms that unrelated names share.
TRIVIAL_TOKENS = (
    "company manufacturing group holding holdings corporation limited international industries enterprise enterprises incorporated association gesellschaft beschrankter "
    "haftung aktiengesellschaft kommanditgesellschaft offene handelsgesellschaft societa azioni responsabilita limitata forma abbreviata oppure breve reszvenytarsasag "
    "zartkoruen mukodo korlatolt felelossegu tarsasag nyilvanosan gyarto forgalmazo gyartasi szolgaltato kereskedelmi gepjarmu alkatresz societe anonyme responsabilite "
    "limitee sociedad anonima responsabilidad unipessoal lda unipersonal zoo systems technology technologies engineering services solutions components parts production "
    "produktion werke fabrik"
).split()

# Names too general to be looked for by likeness.
GENERIC_NAMES = "systems energy finance transport technology engineering manufacturing industry electric green innovation development infrastructure logistics digital services".split()

# Names that are no entry of a list of organisations.
LIST_EXCLUDE = ["group", "other", "others", "mobility", "gac", "total", "grand total", "all others", "rest"]

# Legal forms as patterns, in the order in which they are tried.
LEGAL_FORMS = [
    r"gesellschaft\s+mit\s+beschr[äa]nkter\s+haftung", r"societe\s+anonyme", r"limited\s+liability\s+company", r"corporation", r"incorporated", r"limited",
    r"aktiengesellschaft", r"aktiebolag", r"gmbh\s*&?\s*co\.?\s*kg", r"gmbh", r"s\s*\.?\s*p\s*\.?\s*a\.?", r"s\s*\.?\s*r\s*\.?\s*l\.?", r"s\s*\.?\s*r\s*\.?\s*o\.?",
    r"s\s*\.?\s*a\s*\.?\s*s\.?", r"s\s*\.?\s*a\s*\.?\s*r\s*\.?\s*l\.?", r"n\s*\.?\s*v\.?", r"b\s*\.?\s*v\.?", r"s\.?a\.?", r"a\.?s\.?", r"a\.?g\.?", r"plc", r"ltd", r"llc",
    r"inc", r"corp", r"co\.?", r"ag", r"ab", r"se", r"sa", r"as", r"oy", r"oyj", r"ehf", r"hf", r"d\.?o\.?o\.?", r"sp\.?\s*z\.?\s*o\.?\s*o\.?", r"kft", r"zrt", r"nyrt", r"bt",
    r"z[áa]rtk[öo]r[űu]en\s+m[űu]k[öo]d[öo]\s+r[ée]szv[ée]nyt[áa]rsas[áa]g", r"korl[áa]tolt\s+felel[őo]ss[ée]g[űu]\s+t[áa]rsas[áa]g",
    r"nyilv[áa]nosan\s+m[űu]k[öo]d[öo]\s+r[ée]szv[ée]nyt[áa]rsas[áa]g", r"gy[áa]rt[óo]\s+[ée]s\s+forgalmaz[óo]\s+korl[áa]tolt\s+felel[őo]ss[ée]g[űu]\s+t[áa]rsas[áa]g",
    r"aps", r"a/s", r"srl", r"spa", r"nv", r"bv", r"s\sp\sa", r"s\sr\sl", r"s\sr\so", r"b\sv", r"n\sv", r"unipessoal\s+lda", r"unipessoal", r"lda", r"unipersonal",
    r"societa\s+unipersonale", r"zoo",
]
# Legal forms that parent-group lookup takes off the end of a name, and those that the quality check takes out anywhere.
TRAILING_FORMS = [r"s\.?p\.?a\.?", r"s\.?r\.?l\.?", "gmbh", "ag", "ltd", "inc", "plc", "llc", "corp", r"n\.?v\.?", r"b\.?v\.?", r"a\.?s\.?", "se", "sa", "oy", "co", "kg", r"e\.?v\.?"]
QUALITY_FORMS = [r"s\.?p\.?a\.?", r"s\.?r\.?l\.?", "gmbh", "ag", "ltd", "inc", "plc", "sa", "se", "kft", "zrt", "srl", r"n\.?v\.?", r"b\.?v\.?"]

# Fields of a record's original columns in which names are looked for, and sources whose texts are searched.
CONTEXT_FIELDS = {
    "TAM": ["AM_TITLE", "AM_TITLE_EN", "GRANTING_AUTHORITY_NAME"], "FTS": ["Subject of grant or contract", "Budget line name"], "EIB": ["Region"],
    "EBRD": ["Direct/Regional", "Portfolio Class"], "KOHESIO": [], "CINEA": [], "INNOVFUND": [], "RESEARCH": [], "RRF": ["Component Name", "Measure Description"],
}
CONTEXT_SOURCES = ["TAM", "FTS", "EIB", "EBRD", "KOHESIO", "CINEA", "INNOVFUND"]

# Words too common to find an organisation in a consortium's names.
PHRASE_BLOCKLIST = (
    "group other smart mobility alpine global systems international technology technologies digital innovation energy power green new first general national advanced modern "
    "future life next open best metro urban city plus one star blue ideal china india europe asia super auto motor motors cars electric vehicle vehicles"
).split()

# Grant equivalent of a euro, by instrument.
GRANT_RATES = {"grant": 1.0, "subsidy": 1.0, "procurement": 1.0, "equity": 1.0, "debt_relief": 1.0, "other": 1.0, "mixed": 0.5, "loan": 0.15, "guarantee": 0.1, "tax_advantage": 0.15}
REPAYABLE_ADVANCE_RATE = 0.9

# Members of the union, and blocks of other countries (any further one is Other).
UNION = "AT BE BG CY CZ DE DK EE ES FI FR GR HR HU IE IT LT LU LV MT NL PL PT RO SE SI SK".split()
BLOCKS = {"CN": "CN", "HK": "CN", "MO": "CN", "US": "US", "JP": "JP", "KR": "KR"}

# Spot price of an emission allowance in euros by year, and that of any other year.
ALLOWANCE_PRICES = {
    2005: 22, 2006: 18, 2007: 1, 2008: 22, 2009: 13, 2010: 15, 2011: 13, 2012: 8, 2013: 4, 2014: 6, 2015: 8, 2016: 5, 2017: 6, 2018: 16, 2019: 25, 2020: 25, 2021: 53, 2022: 81,
    2023: 85, 2024: 65, 2025: 70,
}
OTHER_YEARS_PRICE = 50
TRADING_PHASES = [("Phase 1 (2005-07)", 2005, 2007), ("Phase 2 (2008-12)", 2008, 2012), ("Phase 3 (2013-20)", 2013, 2020), ("Phase 4 (2021-24)", 2021, 2024)]

# Score and quality of a bridge row by its signal.
SIGNAL_SCORES = {"beneficiary_name": 100.0, "cordis_company": 90.0, "company+topic": 95.0, "topic_keyword": 70.0}
SIGNAL_QUALITY = {"beneficiary_name": "confirmed", "cordis_company": "cordis_consortium", "company+topic": "cordis_consortium", "topic_keyword": "topic_only"}
RESEARCH_PROGRAMMES = "Horizon 2020|Horizon Europe|Research framework"

# Words of programmes under which a payment repeats an award of another register.
INNOVATION_FUND_WORDS = ["innovation fund", "o.0.1"]
EXECUTIVE_AGENCY_WORDS = ["connecting europe", "cef", "life", "environment and climate action", "emfaf", "maritime, fisheries"]

# How the fund column of any register names a fund.
FUND_ALIASES = {
    "ERDF": ["erdf", "feder", "efre", "fesr", "efrr", "european regional development"],
    "ESF": ["esf", "esf+", "esf plus", "fse", "european social fund", "youth employment initiative"],
    "CF": ["cohesion fund", "fonds de cohesion", "fonds de cohésion", "kohäsionsfonds"],
    "JTF": ["jtf", "just transition"],
    "ESIF": ["esif", "structural and investment", "structural funds"],
    "INTERREG": ["interreg"],
    "RRF": ["rrf", "recovery and resilience"],
    "EAFRD": ["eafrd", "feader"],
    "EAGF": ["eagf", "feaga"],
    "EMFAF": ["emfaf", "european maritime, fisheries and aquaculture", "maritime, fisheries"],
    "HORIZON": ["horizon 2020", "horizon europe", "h2020", "research framework programme", "euratom", "nuclear fission", "joint research centre", "research programme for coal", "research programme for steel"],
    "EIC": ["european innovation council", "eic"],
    "INNOVFUND": ["innovation fund", "innovfund", "innovation fund (if)"],
    "CEF": ["connecting europe facility", "cef", "trans-european networks", "trans-european transport"],
    "LIFE": ["life+", "programme for the environment and climate action", "environment and climate action", "completion of previous programmes in the field of environment"],
    "ERASMUS": ["erasmus+", "erasmus plus", "lifelong learning programme", "promoting learning mobility"],
    "COSME": ["cosme", "competitiveness and innovation framework", "entrepreneurship and innovation programme"],
    "DEP": ["digital europe programme", "dep", "european cybersecurity", "artificial intelligence"],
    "SKILLS": ["skills"],
    "ENI": ["european neighbourhood", "neighbourhood instrument", "neighbourhood and partnership"],
    "IPA": ["ipa", "pre-accession", "candidate countries", "cards"],
    "EDIDP": ["edidp", "european defence industrial development", "defence industrial reinforcement", "defence research", "military mobility"],
    "UCPM": ["union civil protection mechanism", "humanitarian aid", "instrument for stability", "crisis response"],
}
