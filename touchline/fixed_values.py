"""Values that callers and stored data depend on; changing one changes results."""

# Search engines in match order, each with its keyword parameters in order.
ENGINE_PARAMS = {
    "google": ["q"],
    "bing": ["q"],
    "yahoo": ["p"],
    "msn": ["q"],
    "ask": ["q", "ask"],
    "aol": ["q", "query"],
    "duckduckgo": ["q"],
    "baidu": ["wd", "word"],
    "yandex": ["text"],
}

# Hit columns of the landing format, and those a hit must have.
HIT_COLUMNS = [
    "hit_time_gmt", "date_time", "user_agent", "ip", "event_list", "geo_city",
    "geo_region", "geo_country", "pagename", "page_url", "product_list", "referrer",
]
REQUIRED_HIT_COLUMNS = [
    "hit_time_gmt", "ip", "user_agent", "referrer", "event_list", "product_list",
]

# Display names of the curated table and the name of its folder per run date.
CURATED_NAMES = {
    "engine_domain": "Search Engine Domain",
    "keyword": "Search Keyword",
    "revenue": "Revenue",
}
CURATED_SUFFIX = "SearchKeywordPerformance"

# Default table names.
FACT_TABLE = "fact_keyword_performance"
INSIGHT_TABLE = "ai_keyword_insights"

# Masks.
MASKED_IP_PART = "xxx"
MASKED_IP = "xxx.xxx.xxx.xxx"
MASKED_CITY = "masked_city"
MASKED_REGION = "masked_region"
UNKNOWN_COUNTRY = "unknown"
USER_AGENT_PREFIX = "ua_"
USER_AGENT_HEX = 8

# Minutes per time partition.
DEFAULT_INTERVAL_MINUTES = 15

# Report thresholds.
STRONG_REVENUE = 1000.0
MODERATE_REVENUE = 100.0
HIGH_KEYWORD_REVENUE = 100.0
DOMINANT_SHARE = 70.0
EXCELLENT_GROWTH = 15.0
CONCERNING_DROP = 20.0
HIGH_CONCENTRATION = 80.0
LOW_CONCENTRATION = 40.0

# Insight texts by rule.
INSIGHT_TEXT = {
    "rev_strong": "Strong revenue performance with $%.2f total revenue",
    "rev_moderate": "Moderate revenue performance with $%.2f total revenue",
    "rev_low": "Low revenue performance with $%.2f total revenue",
    "top_keyword": "Top performing keyword '%s' on %s generated $%.2f (%.1f%% of total)",
    "dominance": "%s dominates with %.1f%% of total revenue",
    "single_engine": "Single search engine dependency: %s",
    "growth_excellent": "Excellent revenue growth of %.1f%% vs previous period",
    "drop_concerning": "Concerning revenue drop of %.1f%% vs previous period",
    "growth": "Positive revenue growth of %.1f%% vs previous period",
    "decline": "Revenue decline of %.1f%% vs previous period",
    "concentration_high": "High concentration: top 5 keywords drive most revenue",
    "diversity_good": "Good keyword diversity with distributed revenue",
}

# Recommendation texts by rule, in output order.
RECOMMENDATION_TEXT = {
    "rev_low": [
        "Consider optimizing SEO/SEM strategies for low-performing keywords",
        "Review keyword bidding strategies and ad copy",
    ],
    "one_engine": ["Diversify traffic sources to reduce dependency on single search engine"],
    "dominance": ["Explore opportunities on other search engines to reduce %s dependency"],
    "drop_concerning": [
        "Investigate cause of revenue drop immediately",
        "Consider promotional campaigns to boost performance",
    ],
    "growth_excellent": [
        "Analyze successful strategies and scale them",
        "Consider increasing budget for high-performing keywords",
    ],
    "concentration_high": ["Develop long-tail keyword strategy to reduce concentration risk"],
}
