"""Synthetic account records: every column is a function of the row's key.

No Python runs per row and nothing is shuffled, so the rate grows with the cores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import Hasher, draw, stable_hash

# The pools the text columns draw from.
FIRST_NAMES = ["Ada", "Ben", "Carla", "Dmitri", "Elena", "Farid", "Grace", "Hugo", "Ines", "Jonas",
               "Kira", "Liam", "Mona", "Nils", "Olga", "Pablo"]
LAST_NAMES = ["Abbott", "Brandt", "Costa", "Dubois", "Eriksen", "Fischer", "Garcia", "Hughes",
              "Ivanov", "Jansen", "Keller", "Lopez", "Moreau", "Novak", "Olsen", "Peeters"]
STREETS = ["Station Road", "High Street", "Mill Lane", "Park Avenue", "Church Road", "River Walk",
           "Garden Close", "Market Square"]
CITIES = ["Antwerp", "Bergen", "Cork", "Dresden", "Essen", "Florence", "Ghent", "Hull", "Izmir",
          "Jena", "Krakow", "Lyon", "Malmo", "Nantes", "Oporto", "Poznan"]
COUNTRY_CODES = ["AT", "AU", "BE", "BR", "CA", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IN",
                 "IT", "JP", "NL", "NO", "PL", "PT", "SE", "TR", "US", "ZA"]
COMPANY_FORMS = ["Ltd", "Inc", "Group", "PLC", "and Sons", "LLC"]
CARD_PROVIDERS = ["VISA 16 digit", "Mastercard", "American Express", "Discover", "Maestro",
                  "JCB 16 digit", "Diners Club"]
JOBS = ["Accountant", "Biologist", "Civil engineer", "Dentist", "Editor", "Florist", "Geologist",
        "Herbalist", "Illustrator", "Journalist", "Librarian", "Midwife", "Nurse", "Optician"]
PREFIXES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Mx."]
# The bank "NWBK" and the country "GB" as the digits of an IBAN check sum (A = 10 … Z = 35).
IBAN_COUNTRY, IBAN_COUNTRY_DIGITS = "GB", "1611"
IBAN_BANK, IBAN_BANK_DIGITS = "NWBK", "23321120"
# Seconds from 1970 to the end of 2024, the span of creation times.
CREATED_SPAN = 1_735_689_600


def _one_of(pool: list[str], key: Column, purpose: str, hasher: Hasher) -> Column:
    values = F.array(*[F.lit(item) for item in pool])
    return F.get(values, draw(key, purpose, len(pool), hasher).cast("int"))


def _digits(key: Column, purpose: str, width: int, hasher: Hasher) -> Column:
    return F.lpad(draw(key, purpose, 10**width, hasher).cast("string"), width, "0")


def card_number(key: Column, hasher: Hasher = stable_hash) -> Column:
    """16 digits starting with 4, the last one the Luhn check digit."""
    body = F.concat(F.lit("4"), _digits(key, "card", 14, hasher))
    digits = [F.substring(body, place, 1).cast("int") for place in range(1, 16)]
    # Odd places are doubled; a two-digit double counts as its digit sum.
    total = F.lit(0)
    for place, digit in enumerate(digits, start=1):
        total = total + (2 * digit - F.when(digit > 4, 9).otherwise(0) if place % 2 else digit)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def iban(key: Column, hasher: Hasher = stable_hash) -> Column:
    """A British-style number whose check digits satisfy the mod-97 rule."""
    account = _digits(key, "iban", 14, hasher)
    remainder = F.concat(
        F.lit(IBAN_BANK_DIGITS), account, F.lit(IBAN_COUNTRY_DIGITS + "00")
    ).cast("decimal(38,0)") % F.lit(97).cast("decimal(38,0)")
    check = F.lpad((98 - remainder.cast("int")).cast("string"), 2, "0")
    return F.concat(F.lit(IBAN_COUNTRY), check, F.lit(IBAN_BANK), account)


def uuid4(key: Column) -> Column:
    """The md5 of the key in the layout of a version 4 UUID."""
    h = F.md5(F.concat_ws("|", key.cast("string"), F.lit("uuid")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def account_columns(key: Column, today: Column, hasher: Hasher = stable_hash) -> list[Column]:
    """The 14 columns of an account record, as they appear in its JSON message."""
    def one_of(pool: list[str], purpose: str) -> Column:
        return _one_of(pool, key, purpose, hasher)

    created = F.timestamp_seconds(draw(key, "created", CREATED_SPAN, hasher))
    expires = F.add_months(today, draw(key, "expires", 121, hasher).cast("int"))
    house = (1 + draw(key, "house", 999, hasher)).cast("string")
    return [
        F.concat_ws(" ", one_of(FIRST_NAMES, "first"), one_of(LAST_NAMES, "last")).alias("name"),
        F.concat(house, F.lit(" "), one_of(STREETS, "street"), F.lit("\n"),
                 one_of(CITIES, "address city"), F.lit(" "), _digits(key, "zip", 5, hasher)).alias("address"),
        one_of(COUNTRY_CODES, "country").alias("country_code"),
        one_of(CITIES, "city").alias("city"),
        iban(key, hasher).alias("bank_iban"),
        F.concat_ws(" ", one_of(LAST_NAMES, "company"), one_of(COMPANY_FORMS, "form")).alias("company"),
        card_number(key, hasher).alias("credit_card"),
        one_of(CARD_PROVIDERS, "card provider").alias("credit_card_provider"),
        F.date_format(expires, "MM/yy").alias("credit_card_expires"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("date_record_created"),
        one_of(JOBS, "job").alias("employement"),
        uuid4(key).alias("emp_id"),
        one_of(PREFIXES, "prefix").alias("name_prefix"),
        F.concat_ws("-", _digits(key, "area", 3, hasher), _digits(key, "exchange", 3, hasher),
                    _digits(key, "line", 4, hasher)).alias("phone_number"),
    ]


def generate_accounts(
    spark: SparkSession, count: int, partitions: int | None = None, seed: int = 0
) -> DataFrame:
    """``count`` records; another ``seed`` gives other records."""
    rows = spark.range(0, count, 1, partitions)
    return rows.select(*account_columns(F.concat_ws(":", F.lit(seed), F.col("id")), F.current_date()))
