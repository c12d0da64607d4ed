"""Lookup tables of the reference data: shop categories, state names, merchant codes."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Map-shop kind -> standard category and risk level.
CATEGORY_MAP = """\
sub_category,standardized_category,risk_level
restaurant,FOOD_AND_DRINK,LOW
yes,GENERAL_RETAIL,LOW
fuel,TRANSPORT,LOW
clothes,RETAIL,LOW
hotel,TRAVEL,HIGH
fast_food,FOOD_AND_DRINK,LOW
convenience,GROCERY,LOW
cafe,FOOD_AND_DRINK,LOW
bakery,FOOD_AND_DRINK,LOW
supermarket,GROCERY,LOW
pharmacy,MEDICAL,LOW
guest_house,TRAVEL,MEDIUM
general,GENERAL_RETAIL,LOW
hairdresser,SERVICES,LOW
jewelry,LUXURY,VERY_HIGH
mobile_phone,ELECTRONICS,HIGH
electronics,ELECTRONICS,HIGH
beauty,SERVICES,LOW
hardware,HOME_GARDEN,LOW
medical_supply,MEDICAL,LOW
shoes,RETAIL,LOW
stationery,RETAIL,LOW
greengrocer,FOOD_AND_DRINK,LOW
tailor,SERVICES,LOW
bar,FOOD_AND_DRINK,MEDIUM
car,AUTOMOTIVE,HIGH
furniture,HOME_GARDEN,MEDIUM
grocery,GROCERY,LOW
motorcycle,AUTOMOTIVE,HIGH
car_repair,AUTOMOTIVE,MEDIUM
dairy,GROCERY,LOW
confectionery,FOOD_AND_DRINK,LOW
butcher,FOOD_AND_DRINK,LOW
cinema,ENTERTAINMENT,LOW
books,RETAIL,LOW
motorcycle_repair,AUTOMOTIVE,MEDIUM
department_store,RETAIL,LOW
travel_agency,TRAVEL,HIGH
optician,MEDICAL,MEDIUM
mall,RETAIL,LOW
computer,ELECTRONICS,HIGH
tea,FOOD_AND_DRINK,LOW
gift,RETAIL,LOW
alcohol,ALCOHOL,HIGH
electrical,HOME_GARDEN,LOW
tyres,AUTOMOTIVE,MEDIUM
copyshop,SERVICES,LOW
chemist,MEDICAL,LOW
car_parts,AUTOMOTIVE,MEDIUM
bicycle,AUTOMOTIVE,LOW
ticket,ENTERTAINMENT,MEDIUM
sports,RETAIL,LOW
kiosk,GROCERY,LOW
photo,SERVICES,LOW
motel,TRAVEL,HIGH
florist,RETAIL,LOW
beverages,GROCERY,LOW
pastry,FOOD_AND_DRINK,LOW
pub,FOOD_AND_DRINK,MEDIUM
trade,B2B_WHOLESALE,LOW
pet,RETAIL,LOW
bag,RETAIL,LOW
cosmetics,RETAIL,LOW
laundry,SERVICES,LOW
appliance,ELECTRONICS,MEDIUM
interior_decoration,HOME_GARDEN,LOW
houseware,HOME_GARDEN,LOW
wine,ALCOHOL,HIGH
paint,HOME_GARDEN,LOW
watches,LUXURY,VERY_HIGH
variety_store,RETAIL,LOW
fashion_accessories,RETAIL,LOW
dry_cleaning,SERVICES,LOW
seafood,FOOD_AND_DRINK,LOW
agrarian,GROCERY,LOW
wholesale,B2B_WHOLESALE,LOW
toys,RETAIL,LOW
garden_centre,HOME_GARDEN,LOW
gas,TRANSPORT,LOW
farm,GROCERY,LOW
fabric,RETAIL,LOW
doityourself,HOME_GARDEN,LOW
tiles,HOME_GARDEN,LOW
bed,HOME_GARDEN,LOW
art,LUXURY,HIGH
repair,SERVICES,LOW
baby_goods,RETAIL,LOW
tobacco,ALCOHOL,HIGH
lottery,GAMBLING,VERY_HIGH
religion,CHARITY,LOW
spices,GROCERY,LOW
coffee,FOOD_AND_DRINK,LOW
tattoo,SERVICES,LOW
boutique,RETAIL,MEDIUM
lighting,HOME_GARDEN,LOW
kitchen,HOME_GARDEN,LOW
massage,SERVICES,LOW
fishing,RETAIL,LOW
health_food,GROCERY,LOW
musical_instrument,RETAIL,MEDIUM
"""

# Raw state name -> clean name. PUNJAB appears twice and two names are padded.
STATE_MAP = """\
raw_name,clean_name
AP,Andhra Pradesh
ANDRA PRADESH,Andhra Pradesh
ANDHRA PRADESH,Andhra Pradesh
AR,Arunachal Pradesh
AS,Assam
ASSAM,Assam
BR,Bihar
BIHAR,Bihar
CT,Chhattisgarh
CHHATTISGARH,Chhattisgarh
CHANDIGARH,Chandigarh
DD,Daman and Diu
DAMAN AND DIU,Daman and Diu
DAMAN & DIU,Daman and Diu
DL,Delhi
DELHI,Delhi
NCR,Delhi
GA,Goa
GOA,Goa
GJ,Gujarat
GUJARAT,Gujarat
GU,Gujarat
HR,Haryana
HARYANA,Haryana
HP,Himachal Pradesh
HIMACHAL PRADESH,Himachal Pradesh
JK,Jammu and Kashmir
J AND K,Jammu and Kashmir
JAMMU AND KASHMIR,Jammu and Kashmir
JAMMU & KASHMIR,Jammu and Kashmir
KASHMIR,Jammu and Kashmir
JH,Jharkhand
JHARKHAND,Jharkhand
KA,Karnataka
KARNATAKA,Karnataka
KL,Kerala
KERALA,Kerala
KERA,Kerala
MP,Madhya Pradesh
MADHYA PRADESH,Madhya Pradesh
MH,Maharashtra
MAHARASTRA,Maharashtra
MAHARASHTRA,Maharashtra
GAJANAN MAHARAJ TEMPLE MALKHED BK NER YAVATMAL MAHARASHTRA INDIA, Maharashtra
MN,Manipur
MANIPUR,Manipur
ML,Meghalaya
MEGHALAYA,Meghalaya
MZ,Mizoram
MIZORAM,Mizoram
NL,Nagaland
NAGALAND,Nagaland
OR,Odisha
ODHISA,Odisha
ODISHA,Odisha
PB,Punjab
PUNJAB,Punjab
PUNJAB,Punjab
"Punjab, India", Punjab
PY,Puducherry
PUDUCHERRY,Puducherry
RJ,Rajasthan
RAJASTHAN,Rajasthan
SK,Sikkim
SIKKIM,Sikkim
TN,Tamil Nadu
TAMIL NADU,Tamil Nadu
TAMILNADU,Tamil Nadu
தமிழ்நாடு,Tamil Nadu
TG,Telangana
TS,Telangana
TELANGANA,Telangana
TELANAGANA,Telangana
TELENGANA,Telangana
TR,Tripura
UP,Uttar Pradesh
UTTAR PRADESH,Uttar Pradesh
UK,Uttarakhand
UTTARAKHAND,Uttarakhand
WB,West Bengal
WEST BENGAL,West Bengal
None,Unknown
"""

# Canonical state name -> lower-case spellings.
STATE_ALIASES = {
    "Andhra Pradesh": ["andhra pradesh", "ap", "andra pradesh"],
    "Arunachal Pradesh": ["arunachal pradesh"],
    "Assam": ["assam", "as"],
    "Bihar": ["bihar"],
    "Chandigarh": ["chandigarh"],
    "Chhattisgarh": ["chhattisgarh"],
    "Delhi": ["delhi", "dl", "delhi-nct", "ncr"],
    "Goa": ["goa"],
    "Gujarat": ["gujarat", "gj", "gu", "gujrat"],
    "Haryana": ["haryana", "hr"],
    "Himachal Pradesh": ["himachal pradesh"],
    "Jammu and Kashmir": ["jammu and kashmir", "jammu & kashmir", "j and k", "kashmir"],
    "Jharkhand": ["jharkhand"],
    "Karnataka": ["karnataka", "ka"],
    "Kerala": ["kerala", "kl", "kera"],
    "Ladakh": ["ladakh"],
    "Madhya Pradesh": ["madhya pradesh", "mp"],
    "Maharashtra": ["maharashtra", "mh", "maharastra"],
    "Manipur": ["manipur"],
    "Meghalaya": ["meghalaya"],
    "Mizoram": ["mizoram"],
    "Nagaland": ["nagaland"],
    "Odisha": ["odisha", "or", "odhisa"],
    "Puducherry": ["puducherry"],
    "Punjab": ["punjab", "punjab, india"],
    "Rajasthan": ["rajasthan", "rj"],
    "Sikkim": ["sikkim"],
    "Tamil Nadu": ["tamil nadu", "tn", "tamilnadu", "தமிழ்நாடு"],
    "Telangana": ["telangana", "tg", "telanagana"],
    "Tripura": ["tripura"],
    "Uttar Pradesh": ["uttar pradesh", "up", "utrar pradesh"],
    "Uttarakhand": ["uttarakhand"],
    "West Bengal": ["west bengal", "wb", "west-bengal"],
    "Dadra and Nagar Haveli and Daman and Diu": ["dadra and nagar haveli", "daman and diu"],
    "Andaman and Nicobar Islands": ["andaman and nicobar islands"],
}

# Standard category -> merchant category code; anything else is 5999.
MERCHANT_CODES = {
    "GROCERY": "5411",
    "FOOD_AND_DRINK": "5812",
    "GENERAL_RETAIL": "5311",
    "SERVICES": "7299",
    "ENTERTAINMENT": "7999",
    "ELECTRONICS": "5732",
    "TRAVEL": "4722",
    "MEDICAL": "8099",
    "AUTOMOTIVE": "5511",
    "LUXURY": "5944",
    "B2B_WHOLESALE": "5099",
    "HOME_GARDEN": "5200",
    "TRANSPORT": "4111",
    "CHARITY": "8398",
    "RETAIL": "5999",
    "ALCOHOL": "5921",
    "GAMBLING": "7995",
}
DEFAULT_MERCHANT_CODE = "5999"

CATEGORY_SCHEMA = "sub_category string, standardized_category string, risk_level string"
STATE_SCHEMA = "raw_name string, clean_name string"


def csv_rows(text: str) -> list[list[str]]:
    return list(csv.reader(io.StringIO(text)))[1:]


def category_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(csv_rows(CATEGORY_MAP), CATEGORY_SCHEMA)


def state_map(spark: SparkSession) -> DataFrame:
    """The list as given, with its duplicate key and padded names."""
    return spark.createDataFrame(csv_rows(STATE_MAP), STATE_SCHEMA)


def state_aliases(spark: SparkSession) -> DataFrame:
    rows = [(alias, name) for name, aliases in STATE_ALIASES.items() for alias in aliases]
    return spark.createDataFrame(rows, "alias string, canonical string")


def merchant_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MERCHANT_CODES.items()), "category string, mcc string")


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup kept as CSV with a header line."""
    return spark.read.csv(path, header=True, schema=schema)


def unique_lookup(df: DataFrame, key: str) -> DataFrame:
    """One row per normalised key, values trimmed; the smallest value wins."""
    values = [c for c in df.columns if c != key]
    trimmed = df.select(F.trim(F.upper(key)).alias(key), *[F.trim(c).alias(c) for c in values])
    return trimmed.groupBy(key).agg(*[F.min(c).alias(c) for c in values])
