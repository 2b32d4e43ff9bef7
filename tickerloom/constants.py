"""Word lists, patterns and code tables that results depend on."""

# Fixed values - rule patterns per event family.
EVENT_FAMILIES: dict[str, list[str]] = {
    "ma": [
        r"\bacquisition\b", r"\bfusion\b", r"\brachat\b", r"\bOPA\b", r"\bcession\b",
        r"\boffre publique\b", r"\bprise de participation\b", r"\bmerger\b",
        r"\btakeover\b", r"\bconsortium\b",
    ],
    "earnings": [
        r"\brésultats?\b", r"\bbénéfice[s]?\b", r"\bEBIT\b", r"\bEBITDA\b",
        r"\bchiffre d.affaires\b", r"\brevenus?\b", r"\bdividende[s]?\b",
        r"\bbénéfice net\b", r"\bmarge\b", r"\bperte[s]?\b", r"\bprofit[s]?\b",
        r"\bearnings\b",
    ],
    "management": [
        r"\bPDG\b", r"\bdirecteur.général\b", r"\bnomination\b", r"\bdémission\b",
        r"\bconseil d.administration\b", r"\bprésidence\b", r"\bnommé\b", r"\bCEO\b",
        r"\bretraite\b", r"\bcomité exécutif\b",
    ],
    "legal": [
        r"\bprocès\b", r"\blitige\b", r"\bsanction\b", r"\bamende\b", r"\btribunal\b",
        r"\brégulateur\b", r"\bpoursuite[s]?\b", r"\bplainte\b", r"\benquête\b",
        r"\bfraud[e]?\b", r"\bcorruption\b",
    ],
}

# Fixed values - negation and speculation patterns.
NEGATION = [
    r"\bne\b.{0,25}\bpas\b", r"\baucun\b", r"\bpas de\b", r"\bn.a pas\b",
    r"\bn.ont pas\b", r"\bjamais\b", r"\bsans\b",
]
SPECULATION = [
    r"\bpourrait\b", r"\benvisage\b", r"\bprévoit\b", r"\bselon des sources\b",
    r"\brumeur\b", r"\bdevrait\b", r"\bserait\b", r"\bnégociation[s]?\b",
    r"\bdiscussion[s]?\b", r"\bà l.étude\b", r"\bselon nos informations\b",
]

# Fixed values - sentiment stems.
POSITIVE_STEMS = [
    "croissance", "hausse", "progression", "bénéfice", "profit", "succès", "record",
    "expansion", "rebond", "gain", "dynamique", "excellent", "performant",
    "amélioration", "solide", "fort", "optimiste", "positif", "accroissement",
    "développement",
]
NEGATIVE_STEMS = [
    "baisse", "chute", "perte", "recul", "déficit", "déclin", "difficile", "crise",
    "risque", "incertitude", "ralentissement", "préoccupation", "tension", "négatif",
    "détérioration", "pessimiste", "fragilité", "dégradation",
]

# Fixed values - event types, alphabetical.
EVENT_TYPES = [
    "capital_operation", "debt_issuance", "dividend_announcement", "earnings_release",
    "economic_indicator", "ipo_listing", "leadership_change", "ma_deal", "market_data",
    "other", "project_contract", "regulatory_action", "strategic_plan",
]

# Fixed values - sentiment label spellings.
SENTIMENT_ALIASES = {
    "positive": "positive", "positif": "positive",
    "négatif": "negative", "negatif": "negative", "negative": "negative",
    "neutral": "neutral", "neutre": "neutral", "mixed": "neutral",
    "mitigé": "neutral", "mitige": "neutral",
    "neutre-positif": "positive", "neutre‑positif": "positive",
    "neutre-négatif": "negative", "neutre‑négatif": "negative",
}

# Fixed values - event type aliases; the first alias contained in the text wins.
EVENT_ALIASES = {
    "résultats": "earnings_release",
    "dividende": "dividend_announcement",
    "augmentation": "capital_operation",
    "obligataire": "debt_issuance",
    "acquisition": "ma_deal",
    "fusion": "ma_deal",
    "cession": "ma_deal",
    "nomination": "leadership_change",
    "démission": "leadership_change",
    "réglementation": "regulatory_action",
    "ammc": "regulatory_action",
    "bkam": "regulatory_action",
    "stratégie": "strategic_plan",
    "indice": "market_data",
    "masi": "market_data",
    "indicateur": "economic_indicator",
    "contrat": "project_contract",
    "marché": "project_contract",
    "introduction": "ipo_listing",
}

# Fixed values - sentiment label polarity.
POLARITY = {"positive": 1.0, "neutral": 0.0, "negative": -1.0}

# Fixed values - words too common in company names to be keywords.
NAME_STOP_WORDS = [
    "bank", "maroc", "groupe", "société", "compagnie", "holding", "africa",
    "nationale", "general", "générale",
]

# Fixed values - currency codes by description.
CURRENCY_CODES = {
    "1 EURO": "EUR",
    "1 DOLLAR U.S.A.": "USD",
    "1 DOLLAR CANADIEN": "CAD",
    "1 LIVRE STERLING": "GBP",
    "1 LIVRE GIBRALTAR": "GIP",
    "1 FRANC SUISSE": "CHF",
    "1 RIYAL SAOUDIEN": "SAR",
    "1 DINAR KOWEITIEN": "KWD",
    "1 DIRHAM E.A.U.": "AED",
    "1 RIYAL QATARI": "QAR",
    "1 DINAR BAHREINI": "BHD",
    "100 YENS JAPONAIS": "JPY",
    "1 RIYAL OMANI": "OMR",
    "1 RUBLE RUSSE": "RUB",
    "1 YUAN CHINOIS": "CNY",
    "1 DOLLAR HONG KONG": "HKD",
    "1 DOLLAR SINGAPOUR": "SGD",
    "1 WON SUD-COREEN": "KRW",
    "1 PESO MEXICAIN": "MXN",
    "1 PESO ARGENTIN": "ARS",
    "1 DOLLAR AUSTRALIEN": "AUD",
    "1 DOLLAR NEO-ZELANDAIS": "NZD",
    "1 COURONNE SUEDOISE": "SEK",
    "1 COURONNE NORVEGIENNE": "NOK",
    "1 COURONNE DANOISE": "DKK",
    "1 ZLOTY POLONAIS": "PLN",
    "1 FORINT HONGROIS": "HUF",
    "1 LEU ROUMAIN": "RON",
    "1 DIRHAM MAROCAIN": "MAD",
    "1 DINAR ALGÉRIEN": "DZD",
    "1 TUNISIE DINAR": "TND",
    "1 LIVRE ÉGYPTIENNE": "EGP",
    "1 RIAL IRANIEN": "IRR",
    "1 RUPIAH INDONESIENNE": "IDR",
    "1 RUPIE INDIENNE": "INR",
}

# Fixed values - publication-date meta tags as (attribute, value), most reliable first.
DATE_META_TAGS = [
    ("property", "article:published_time"),
    ("name", "article:published_time"),
    ("property", "og:published_time"),
    ("name", "og:published_time"),
    ("name", "pubdate"),
    ("name", "publish-date"),
    ("name", "date"),
    ("itemprop", "datePublished"),
]

# Fixed values - localized price-history headers.
PRICE_HEADERS = {
    "Date": "date", "Dernier": "close", "Ouv.": "open", "Plus Haut": "high",
    "Plus Bas": "low", "Vol.": "volume", "Variation %": "change_pct",
}

# Fixed values - archive URL filters.
ARCHIVE_EXCLUDE = (
    r"/(tag|category|auteur|author|page|search|feed|wp-admin|wp-content|amp)(/|$|\?)|\?page="
)

SECTOR_OVERLAP = 0.4          # fixed value - share of sector tokens an article must hold
LOOKBACK_DAYS = 7             # fixed value - feed look-back
MARKET_CLOSE = "15:30"        # fixed value - local closing time
MARKET_ZONE = "Africa/Casablanca"
TRADING_DAYS = 252            # fixed value - periods per year
RISK_FREE_ANNUAL = 0.035      # fixed value - yearly risk-free rate

# Columns rolled over the last 3 and 7 rows of a ticker.
ROLL_BASE = [
    "news_count", "avg_sentiment", "std_sentiment", "positive_ratio", "negative_ratio",
    "event_ma", "event_earnings", "event_management", "event_legal",
]
TYPE_FLAGS = [f"llm_evt_{t}" for t in EVENT_TYPES]
ROLL_WINDOWS = (3, 7)

MODEL_FEATURES = [
    *ROLL_BASE, "negated_count", "speculative_count",
    *[f"{c}_r{w}d" for c in ROLL_BASE for w in ROLL_WINDOWS],
]
