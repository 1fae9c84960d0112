"""How precinct labels are printed, county by county.

Each entry is (state, counties, steps); ``None`` stands for any state or any
county.  Entries are tried in order and the first that applies wins, so a
county's own entry stands before its state's.  Steps run in order:
``extract`` keeps the first match (no match: null), ``replace`` rewrites the
first match, ``trim`` trims, ``int`` pads a whole number with zeros.
"""

# fixed values: labels of the ballot files
BALLOT_LABELS = (
    ("ARIZONA", ("MARICOPA",), (("extract", r"^\d{4}"),)),
    ("CALIFORNIA", ("PLACER", "RIVERSIDE", "FRESNO"), (("extract", r"^\d+"),)),
    ("CALIFORNIA", ("SAN DIEGO",), (("extract", r"(?<=\-)\d{6}(?=\-)"),)),
    ("CALIFORNIA", ("KINGS", "ALAMEDA"), (("extract", r"^\d+(?= \()"),)),
    ("CALIFORNIA", ("TEHAMA",), (("extract", r"(?<=00)\d+"),)),
    ("CALIFORNIA", ("KERN",), (("extract", r"\d{7}"),)),
    ("CALIFORNIA", ("CONTRA COSTA",), (("extract", r"^[A-Z0-9]+(?= \d)"),)),
    ("CALIFORNIA", ("MENDOCINO", "MERCED"), (("extract", r"^\d+"),)),
    ("CALIFORNIA", ("SONOMA",), (("extract", r"^[0-9]+(?= )"),)),
    ("CALIFORNIA", ("TUOLUMNE",), (("extract", r"^\d{6}"),)),
    ("CALIFORNIA", ("YUBA",), (("extract", r"^\d{4}"),)),
    ("CALIFORNIA", ("SAN BERNARDINO",), (("extract", r".{7}$"),)),
    ("CALIFORNIA", ("SAN MATEO",), (("extract", r"^\d{4}"),)),
    ("COLORADO", ("ROUTT", "ARAPAHOE", "MOFFAT"), (("extract", r"(?<=\().+?(?=( |\)))"),)),
    ("COLORADO", ("DENVER",), (("extract", r"^\d+(?= \()"),)),
    (
        "COLORADO",
        ("MESA", "LARIMER", "EAGLE", "EL PASO", "ADAMS", "PUEBLO", "YUMA", "MOFFAT", "JEFFERSON", "TELLER"),
        (("extract", r"^\d+(?= \-)"),),
    ),
    ("COLORADO", ("WELD",), (("extract", r"^\d+(?= \-)"),)),
    ("COLORADO", None, (("extract", r"^\d{10}"),)),
    (
        "GEORGIA",
        ("COLUMBIA",),
        (
            ("replace", r"^\d{3}\-", ""),
            ("replace", r"[0-9][A-Z]?$", ""),
            ("replace", r"CC$", ""),
            ("replace", r"CO$", ""),
            ("replace", r"2C$", ""),
            ("replace", r"(?<=LPG)[OC]+", ""),
            ("replace", r"(?<=HBL).$", ""),
            ("replace", r"(?<=GPSS)..$", ""),
        ),
    ),
    ("GEORGIA", ("BIBB",), (("replace", r"^\d{3}\-", ""), ("replace", r"[A-Z]$", ""))),
    (
        "GEORGIA",
        ("EARLY",),
        (("extract", r"(?<=\-)[A-Z][SU]?"), ("replace", r"D", "A"), ("replace", r"J", "CS")),
    ),
    ("GEORGIA", ("GWINNETT",), (("extract", r"(?<=\-)\d{3}"),)),
    ("GEORGIA", ("COBB",), (("extract", r".{4}$"),)),
    ("GEORGIA", None, (("extract", r"(?<=\-).+?$"),)),
    ("IOWA", ("DICKINSON",), (("extract", r"(?<=No\. )(\d+)"),)),
    ("MARYLAND", ("HARFORD", "PRINCE GEORGE'S"), (("replace", r"^0", ""),)),
    ("MICHIGAN", ("CHARLEVOIX",), (("extract", r"(?<=Precinct )\d+"),)),
    ("MICHIGAN", ("CLINTON",), (("extract", r"\d+"),)),
    ("NEVADA", ("DOUGLAS",), (("extract", r"^\d+"),)),
    ("NEVADA", ("PERSHING",), (("extract", r"PRECINCT \d+"),)),
    ("NEVADA", ("LYON",), (("extract", r".+?\d+"),)),
    (
        "NEW JERSEY",
        ("BERGEN",),
        (("replace", r" \- Ward \d", ""), ("replace", r"(Borough|City|Township|Village) of", "")),
    ),
    (
        "NEW JERSEY",
        ("PASSAIC", "MONMOUTH"),
        (("extract", r".+?(?= (\- \d)|Cong|Mail|Prov)"), ("trim",), ("replace", r"boro boro", "boro")),
    ),
    ("NEW JERSEY", ("SALEM",), (("extract", r".+?(?= District|East|West)"),)),
    (
        "NEW JERSEY",
        ("GLOUCESTER",),
        (("replace", r"(\- WARD|DISTRICT).+", ""), ("replace", r"(BOROUGH|CITY|TOWNSHIP) OF ", ""), ("trim",)),
    ),
    ("OHIO", ("BELMONT",), (("replace", r"^[0-9.,]+", ""),)),
    ("OHIO", ("WAYNE",), (("extract", r"^[0-9]+"),)),
    ("OHIO", ("ASHTABULA", "WOOD"), (("replace", r"^[0-9.]+? ", ""),)),
    ("OHIO", ("HARRISON", "GREENE"), (("extract", r"^\d+"),)),
    ("OHIO", ("RICHLAND",), (("extract", r"^.+?(?=\-)"),)),
    ("OREGON", ("MARION",), (("extract", r"^\d+"),)),
    ("OREGON", ("YAMHILL",), (("extract", r"^\d+"), ("replace", r"^0*", ""))),
    ("TEXAS", ("FORT BEND",), (("extract", r"^\d+"),)),
    ("TEXAS", ("TAYLOR", "HIDALGO", "COLLIN"), (("extract", r"^\d{3}A?"),)),
    ("TEXAS", ("SMITH",), (("extract", r"^\d+"), ("replace", r"^0+", ""), ("int", 3))),
    ("TEXAS", ("POTTER",), (("replace", r" County Only\s*", ""),)),
)

# fixed values: labels of the returns
RETURNS_LABELS = (
    ("ARIZONA", ("MARICOPA",), (("extract", r"^\d{4}"),)),
    ("CALIFORNIA", None, (("extract", r"(?<=\d{5}).+?(?=\_)"),)),
    ("NEVADA", ("DOUGLAS",), (("extract", r"^\d+"),)),
    ("OHIO", ("GREENE",), (("extract", r"\d+$"),)),
    (None, ("ASHTABULA",), (("replace", r"^PRECINCT ", ""),)),
    ("TEXAS", ("TAYLOR", "HIDALGO", "COLLIN", "SMITH", "POTTER"), (("extract", r"\d{3}$"),)),
    ("TEXAS", ("FORT BEND",), (("extract", r"\d{4}$"),)),
)
