"""Portfolios, domain weights, word lists and text patterns.

Everything here must equal the study's published configuration for results to
agree. Every operator takes these as parameters; the names below are defaults.
"""

# --- fixed values: portfolio members -----------------------------------------
PORTFOLIOS = {
    "geopolitical": ["GLD", "USO", "LMT", "RTX", "EEM", "GC=F", "CL=F"],
    "tech": ["AAPL", "MSFT", "NVDA", "GOOGL", "META", "AMZN", "TSLA", "SOXX", "QQQ"],
    "balanced": ["SPY", "AGG", "GLD", "VTI", "EFA", "BND"],
    "conservative": ["TLT", "IEF", "VPU", "KO", "JNJ", "PG", "XLP"],
}
MARKET_TICKER = "SPY"
SHOCK_PORTFOLIO = "tech"
GOLD_TICKER = "GLD"
SAFE_HAVEN = ["GLD", "GC=F", "TLT", "IEF", "BND", "AGG", "VPU"]

# --- fixed values: archetypes of the significance tests ----------------------
ARCHETYPES = {
    "tech": ["AAPL", "MSFT", "NVDA", "AMZN", "GOOGL", "META", "TSLA"],
    "defensive": ["PG", "JNJ", "KO"],
    "safe": ["GLD", "TLT", "IEF"],
    "geo": ["LMT", "RTX", "USO"],
}

# --- fixed values: news domains, their weights and load order ----------------
DOMAINS = ["financial", "geopolitical", "technology"]
DOMAIN_WEIGHTS = {
    "geopolitical": {"geopolitical": 0.6, "financial": 0.3, "technology": 0.1},
    "tech": {"technology": 0.6, "financial": 0.3, "geopolitical": 0.1},
    "balanced": {"financial": 0.4, "geopolitical": 0.3, "technology": 0.3},
    "conservative": {"financial": 0.5, "geopolitical": 0.4, "technology": 0.1},
}
CAUSE_EFFECT_PAIRS = [
    ("geopolitical", "tech"),
    ("financial", "tech"),
    ("geopolitical", "balanced"),
    ("technology", "geopolitical"),
    ("financial", "balanced"),
]

# --- fixed values: junk patterns ---------------------------------------------
JUNK_PATTERNS = [
    r"^(live updates?|live blog)",
    r"(results? (live|announced)|live result)",
    r"^(word of the day|quote of the day)",
    r"(wishes|greetings|messages|images quotes)",
    r"^(sensex today|gold rate today|nifty today)",
    r"(election \d{4} result)",
    r"(board results \d{4})",
    r"^oscars? (winner|results?)",
]
JUNK_SHORT = "live updates?|live blog|word of the day|quote of the day|sensex today|nifty updates"

# --- fixed values: relevance words -------------------------------------------
TECH_WORDS = [
    "AI", "Artificial Intelligence", "NVIDIA", "OpenAI", "Semiconductor",
    "TSMC", "IPO", "Layoff", "Cloud", "Computing", "Machine Learning",
    "Cybersecurity", "Startup", "Venture Capital", "Big Tech", "Regulation",
    "Quantum", "Automation", "SaaS", "Fintech",
]
GEO_WORDS = [
    "sanctions", "war", "invasion", "geopolitical", "NATO", "Russia", "China",
    "Ukraine", "Taiwan", "Middle East", "Israel", "Palestine", "OPEC", "Crude Oil",
    "Trade War", "Tariff", "Federal Reserve", "Inflation", "Election Fraud",
    "Nuclear", "United Nations", "G7", "G20", "Diplomacy", "Military", "Coup",
]

# --- fixed values: branding suffixes cut from headlines -----------------------
BRANDING = {
    "financial": ["ET Markets?", "Moneycontrol", "Livemint", "BSE", "NSE", "Reuters",
                  "NYT", "BBC", "CNN", "AP", "Guardian"],
    "financial_archive": ["ET Markets?", "Moneycontrol", "Livemint", "BSE", "NSE", "Reuters"],
    "geopolitical": ["Reuters", "NYT", "Bloomberg", "BBC", "CNN", "AP", "Guardian", "Hacker News"],
    "technology": ["TechCrunch", "Hacker News", "Reuters", "NYT", "BBC", "CNN", "AP", "Guardian"],
}

# --- fixed values: page containers that hold headlines, per site --------------
# (tag, class or None); a container yields its first link
SITE_CONTAINERS = {
    "Moneycontrol": "div.MT15, li.clearfix, h2, h3",
    "EconomicTimes": "div.eachStory, div.main-content li",
    "Livemint": "div.listing_row",
}
LISTING_CONTAINERS = {
    "Moneycontrol": "li.clearfix, div.f3",
    "EconomicTimes": "div.eachStory, ul.content li",
    "Livemint": "div.listing_row, div.headline_list",
}

# --- fixed values: model settings ---------------------------------------------
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
MAX_LAG = 5
SNAPSHOT_HOURS = [4, 7, 10]

# Small default polarity lexicon; callers pass their own table for real work.
LEXICON = {
    "gain": 2.0, "growth": 1.6, "record": 1.2, "strong": 2.3, "profit": 1.9,
    "surge": 1.5, "rally": 1.7, "peace": 2.5, "win": 2.8, "good": 1.9,
    "loss": -1.3, "crash": -1.7, "war": -2.9, "weak": -1.9, "risk": -1.1,
    "fear": -2.2, "fraud": -2.8, "attack": -2.1, "crisis": -3.1, "bad": -2.5,
    "stupid": -2.4, "worthless": -1.9, "idiot": -2.3, "hate": -2.7,
}
LEXICON_ALPHA = 15.0
