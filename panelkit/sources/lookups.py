"""Fixed lookup tables of the country-panel domain.

Each is an argument of the operator that uses it; these are the defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# File bases of the raw indicators and the column each one feeds.
INDICATOR_FILES = {
    "political_stability": "political stability",
    "gdp_per_capita": "GDP per capita",
    "unemployment": "UNEMPLOYMENT_TOTAL",
    "inflation": "inflation consumer",
    "gdp_growth": "GDP_GROWTH_%",
    "effectiveness": "effectiveness",
    "rule_of_law": "rule of law",
    "trade": "trade",
}

# Spellings that are replaced before entities are matched.
NAME_RECODES = {
    "Turkiye": "Turkey",
    "Viet Nam": "Vietnam",
    "Somalia, Fed. Rep.": "Somalia",
    "Puerto Rico (US)": "Puerto Rico",
}

# UN member states as the indicator files spell them, one per line.
UN_MEMBERS = """
Afghanistan
Albania
Algeria
Andorra
Angola
Antigua and Barbuda
Argentina
Armenia
Australia
Austria
Azerbaijan
Bahamas, The
Bahrain
Bangladesh
Barbados
Belarus
Belgium
Belize
Benin
Bhutan
Bolivia
Bosnia and Herzegovina
Botswana
Brazil
Brunei Darussalam
Bulgaria
Burkina Faso
Burundi
Cabo Verde
Cambodia
Cameroon
Canada
Central African Republic
Chad
Chile
China
Colombia
Comoros
Congo, Dem. Rep.
Congo, Rep.
Costa Rica
Cote d'Ivoire
Croatia
Cuba
Cyprus
Czechia
Denmark
Djibouti
Dominica
Dominican Republic
Ecuador
Egypt, Arab Rep.
El Salvador
Equatorial Guinea
Eritrea
Estonia
Eswatini
Ethiopia
Fiji
Finland
France
Gabon
Gambia, The
Georgia
Germany
Ghana
Greece
Grenada
Guatemala
Guinea
Guinea-Bissau
Guyana
Haiti
Honduras
Hungary
Iceland
India
Indonesia
Iran, Islamic Rep.
Iraq
Ireland
Israel
Italy
Jamaica
Japan
Jordan
Kazakhstan
Kenya
Kiribati
Korea, Dem. People's Rep.
Korea, Rep.
Kuwait
Kyrgyz Republic
Lao PDR
Latvia
Lebanon
Lesotho
Liberia
Libya
Liechtenstein
Lithuania
Luxembourg
Madagascar
Malawi
Malaysia
Maldives
Mali
Malta
Marshall Islands
Mauritania
Mauritius
Mexico
Micronesia, Fed. Sts.
Moldova
Monaco
Mongolia
Montenegro
Morocco
Mozambique
Myanmar
Namibia
Nauru
Nepal
Netherlands
New Zealand
Nicaragua
Niger
Nigeria
North Macedonia
Norway
Oman
Pakistan
Palau
Panama
Papua New Guinea
Paraguay
Peru
Philippines
Poland
Portugal
Qatar
Romania
Russian Federation
Rwanda
Samoa
San Marino
Sao Tome and Principe
Saudi Arabia
Senegal
Serbia
Seychelles
Sierra Leone
Singapore
Slovak Republic
Slovenia
Solomon Islands
Somalia
South Africa
South Sudan
Spain
Sri Lanka
St. Kitts and Nevis
St. Lucia
St. Vincent and the Grenadines
Sudan
Suriname
Sweden
Switzerland
Syrian Arab Republic
Tajikistan
Tanzania
Thailand
Timor-Leste
Togo
Tonga
Trinidad and Tobago
Tunisia
Turkey
Turkmenistan
Tuvalu
Uganda
Ukraine
United Arab Emirates
United Kingdom
United States
Uruguay
Uzbekistan
Vanuatu
Venezuela, RB
Vietnam
Yemen, Rep.
Zambia
Zimbabwe
""".strip().splitlines()

# Further territories with usable data.
TERRITORIES = """
Taiwan, China
Kosovo
West Bank and Gaza
Hong Kong SAR, China
Macao SAR, China
Puerto Rico
Guam
""".strip().splitlines()

# Region -> entities; everything else is "Other".
REGIONS = {
    "Europe": """
        France, Germany, Italy, Spain, United Kingdom, Poland, Netherlands, Belgium,
        Greece, Portugal, Sweden, Austria, Switzerland, Norway, Denmark, Finland, Ireland
    """,
    "Asia": """
        China, India, Japan, South Korea, Indonesia, Thailand, Malaysia, Singapore,
        Philippines, Vietnam, Pakistan, Bangladesh
    """,
    "Americas": """
        United States, Canada, Brazil, Mexico, Argentina, Chile, Colombia, Peru, Venezuela
    """,
    "Africa": """
        South Africa, Nigeria, Egypt, Kenya, Ghana, Ethiopia, Morocco, Algeria, Tunisia
    """,
    "Middle East": """
        Saudi Arabia, United Arab Emirates, Israel, Turkey, Iran
    """,
}


def allowed_entities(spark: SparkSession, entity: str = "entity") -> DataFrame:
    """The default whitelist as a one-column table of 200 rows."""
    rows = [(name,) for name in (*UN_MEMBERS, *TERRITORIES)]
    return spark.createDataFrame(rows, f"`{entity}` string")


def region_table(spark: SparkSession, entity: str = "entity") -> DataFrame:
    """The default (entity, region) lookup."""
    rows = [
        (name, region)
        for region, names in REGIONS.items()
        for name in " ".join(names.split()).split(", ")
    ]
    return spark.createDataFrame(rows, f"`{entity}` string, region string")
