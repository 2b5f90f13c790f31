"""Masking of personal data."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.fixed_values import (
    MASKED_CITY,
    MASKED_IP,
    MASKED_IP_PART,
    MASKED_REGION,
    UNKNOWN_COUNTRY,
    USER_AGENT_HEX,
    USER_AGENT_PREFIX,
)
from touchline.functions.text import text_or_empty

GEO_COLUMNS = ["geo_city", "geo_region", "geo_country"]


def mask_ip(ip: Column) -> Column:
    """Hide the last of four dotted parts; hide anything else as a whole."""
    return F.when(
        ip.rlike(r"(?s)^[^.]*\.[^.]*\.[^.]*\.[^.]*\z"),
        F.concat(F.substring_index(ip, ".", 3), F.lit(f".{MASKED_IP_PART}")),
    ).otherwise(F.lit(MASKED_IP))


def mask_user_agent(user_agent: Column) -> Column:
    digest = F.sha2(user_agent, 256)
    return F.concat(F.lit(USER_AGENT_PREFIX), F.substring(digest, 1, USER_AGENT_HEX))


def mask_location(df: DataFrame) -> DataFrame:
    """Hide city and region and keep the country, on rows that have any of the three."""
    have = [c for c in GEO_COLUMNS if c in df.columns]
    if not have:
        return df
    filled = F.concat(*(text_or_empty(F.col(c)) for c in have)) != ""
    country = F.col("geo_country") if "geo_country" in have else F.lit(None).cast("string")
    masks = {
        "geo_city": F.lit(MASKED_CITY),
        "geo_region": F.lit(MASKED_REGION),
        "geo_country": F.coalesce(F.nullif(country, F.lit("")), F.lit(UNKNOWN_COUNTRY)),
    }
    return df.withColumns(
        {
            c: F.when(filled, mask).otherwise(F.col(c) if c in have else F.lit(None))
            for c, mask in masks.items()
        }
    )


def mask_pii(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Mask ip, user agent and location, as far as the frame has them."""
    if not enabled:
        return df
    masks = {"ip": mask_ip, "user_agent": mask_user_agent}
    present = {c: mask(text_or_empty(F.col(c))) for c, mask in masks.items() if c in df.columns}
    return mask_location(df.withColumns(present) if present else df)
