"""Fixed values of the ballot domain.

Everything here is data that results depend on: names, codes and patterns as
they are printed in the source files.  Logic lives in ``plans``.
"""

# fixed values: the six offices, with the short names used for wide columns
OFFICES = {
    "US PRESIDENT": "uspres",
    "US SENATE": "ussen",
    "US HOUSE": "ushou",
    "STATE SENATE": "stsen",
    "STATE HOUSE": "sthou",
    "GOVERNOR": "stgov",
}
OFFICE_TITLES = {
    "US PRESIDENT": "US President",
    "US SENATE": "US Senate",
    "US HOUSE": "US House",
    "GOVERNOR": "Governor",
    "STATE SENATE": "State Senate",
    "STATE HOUSE": "State House",
}
# fixed values: offices elected by district, by state, and states with one name for both
DISTRICT_OFFICES = ("STATE HOUSE", "STATE SENATE", "US HOUSE")
STATEWIDE_OFFICES = ("GOVERNOR", "US SENATE")
STATEWIDE_STATES = ("ALASKA", "RHODE ISLAND", "DELAWARE")

# fixed values: parties that enter the comparison of tallies
COMPARED_PARTIES = (
    "DEMOCRAT", "REPUBLICAN", "LIBERTARIAN", "GREEN", "NO PARTY AFFILIATION",
    "UNDERVOTE", "UNDERVOTES", "undervote", "WRITEIN", "WRITE-IN",
)
# fixed values: the parties named in reports
MAIN_PARTIES = ("DEMOCRAT", "REPUBLICAN", "LIBERTARIAN")

# fixed values: metadata columns of wide ballot files, not contests
METADATA_COLUMNS = (
    "Cast Vote Record", "Ballot Style", "RowNumber",
    "BoxID", "BoxPosition", "BallotID", "BallotStyleID",
    "PrecinctStyleName", "ScanComputerName", "Status", "Remade",
    "PrecinctStyleName (Redacted to Protect Voter Privacy)",
    "Cvr Number", "Tabulator Num", "Batch Id", "Record Id",
    "Imprinted Id", "Ballot Type", "Counting Group", "Precinct Portion",
    "Dummy Row Number", "Row Number", "Image Path", "Session Type", "Cast.Vote.Record",
    "Ballot.Style", "Voter Flag", "Modified", "Card Info", "Pdf Name", "Unique Voting Identifier",
    "Voting Session Identifier", "CVRNumber", "BallotTypeId",
    "TabulatorId", "BatchId", "RecordId", "Tabulator Name", "Is Current",
    "Box Id", "Box Position", "Ballot Id", "Ballot Style Id", "Scan Computer Name",
)
# fixed values: how a cell spells a choice hidden for privacy
REDACTED_CELLS = ("X", "redacted for voter privacy", "REDACTED", "Redacted", "*", "redacted")
# fixed values: names of the precinct column
PRECINCT_ALIASES = (
    "Precinct Portion", "PrecinctPortionID", "Precinct", "PrecinctID", "Precinct Id", "PrecinctId",
    "Precinct Portion Id", "PrecinctBySplit", "PrecinctPortionId", "Precinct ID",
    "precinct_number", "PRECINCT CODE", "PRECINCT NAME",
)

# fixed values: marks in candidate text that give the party away (first match wins)
PARTY_MARKS = (
    ("CONSTITUTION", r"^CPF "),
    ("GREEN", r"^GRN |\(GRN\)|^MTN "),
    ("LIBERTARIAN", r"^LBT |^LIB | LIB$|^LPN | LPN$|^NMD |\(LIB\)|^LBN "),
    ("DEMOCRAT", r"^DEM | DEM$|\(DEM\)|^DFL | DFL$"),
    ("REPUBLICAN", r"^REP | REP$|\(REP\)"),
    ("SOCIALIST", r"^PGP "),
    ("NO PARTY AFFILIATION", r"^NPA "),
    ("PROGRESSIVE", r"^PRO "),
    ("INDEPENDENT", r"^IND |^IAP "),
    ("GRASSROOTS-LEGALIZE CANNABIS", r"^GLC "),
    ("END THE CORRUPTION", r"^NME "),
    ("WRITEIN", r"Write"),
)
# fixed values: marks removed from candidate text
MARKS_REMOVED = (
    r"^CPF |^GRN |^LBT |^DEM | DEM$|^REP | REP$|^PGP |^NPA |^PRO |^IND |^LIB | LIB$"
    r"|\(REP\)|\(DEM\)|\(LIB\)|\(GRN\)|No image found|^DFL | DFL$|^GLC |^LPN | LPN$|^IAP |^NMD |^NME |^MTN |^LBN "
)
# fixed values: the variant of both lists that one single-race export needs
RACE_EXPORT_PARTY_MARKS = (
    ("CONSTITUTION", r"^CPF "),
    ("GREEN", r"^GRN "),
    ("LIBERTARIAN", r"^LBT |^LIB | LIB$| ^LPN| LPN$"),
    ("DEMOCRAT", r"^DEM | DEM$|\(DEM\)$|^DFL | DFL$"),
    ("REPUBLICAN", r"^REP | REP$|\(REP\)$"),
    ("SOCIALIST", r"^PGP "),
    ("NONPARTISAN", r"^NPA "),
    ("PROGRESSIVE", r"^PRO "),
    ("INDEPENDENT", r"^IND |^IAP "),
    ("GRASSROOTS-LEGALIZE CANNABIS", r"^GLC "),
    ("WRITEIN", r"Write"),
)
RACE_EXPORT_MARKS_REMOVED = (
    r"^CPF |^GRN |^LBT |^DEM | DEM$|^REP | REP$|^PGP |^NPA |^PRO |^IND |^LIB | LIB$"
    r"|\(REP\)$|\(DEM\)$|No image found|^DFL | DFL$|^GLC |^LPN | LPN$|^IAP "
)
# fixed values: presidential candidates: pattern, name, party (none: keep the printed one)
PRESIDENT = (
    (r"Biden", "JOSEPH R BIDEN", "DEMOCRAT"),
    (r"Trump", "DONALD J TRUMP", "REPUBLICAN"),
    (r"Jorgensen", "JO JORGENSEN", "LIBERTARIAN"),
    (r"Hawkins", "HOWIE HAWKINS", "GREEN"),
    (r"Pierce", "BROCK PIERCE", "INDEPENDENT"),
    (r"Blankenship", "DON BLANKENSHIP", "CONSTITUTION"),
    (r"Janos", "JAMES G JANOS", None),
    (r"Fuente|Rocky", "ROCQUE DE LA FUENTE", "REFORM"),
    (r"Kanye|West", "KANYE WEST", None),
    (r"Carroll", "BRIAN T CARROLL", None),
    (r"Gloria|Riva", "GLORIA LA RIVA", None),
)
# fixed value: what is removed from candidate text before and after the marks
TEXT_NOISE = r"^$|^NA$|^N/A$|\([^)]*\)$|\p{Mn}|\p{P}"
# fixed value: a cell that names no one
NO_CHOICE = r"undervote|overvote|No image found"

# fixed values: party names as vendors' party lists print them (first match wins)
PARTY_LIST_MARKS = (
    ("REPUBLICAN", r"REP"),
    ("DEMOCRAT", r"DEM|Democrat|Democratic"),
    ("LIBERTARIAN", r"LBT|Libertarian|Lib|LPN"),
    ("INDEPENDENT", r"IND|IAP|IPN"),
    ("NONPARTISAN", r"NON|NPN|Nonpartisan"),
)

# fixed values: short party codes of the release
SHORT_PARTY = {"DEMOCRAT": "DEM", "REPUBLICAN": "REP", "LIBERTARIAN": "LBT", "GREEN": "GRN"}

# fixed values: item codes of the second team
ITEM_OFFICES = {
    "US_PRES": "US PRESIDENT",
    "US_SEN": "US SENATE",
    "US_SEN (S)": "US SENATE",
    "US_REP": "US HOUSE",
    "ST_SEN": "STATE SENATE",
    "ST_REP": "STATE HOUSE",
    "ST_GOV": "GOVERNOR",
}
ITEM_PARTIES = {
    "DEM": "DEMOCRAT", "DEM?": "DEMOCRAT", "REP": "REPUBLICAN", "REP?": "REPUBLICAN",
    "LBT": "LIBERTARIAN", "IND": "INDEPENDENT", "GRN": "GREEN", "GRE": "GREEN",
    "NPA": "NO PARTY AFFILIATION",
}
AT_LARGE_STATES = (
    "ALASKA", "DELAWARE", "WYOMING", "VERMONT", "MONTANA", "NORTH DAKOTA", "SOUTH DAKOTA",
)
COUNTY_SPELLINGS = {
    "BLECKLY": "BLECKLEY", "GUADELUPE": "GUADALUPE", "ROCKFORD": "WINNEBAGO", "BLOOMINGTON": "MCLEAN",
}

# fixed values: postal codes
POSTAL = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA",
    "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA",
    "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA",
    "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD",
    "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO",
    "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ",
    "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH",
    "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC",
    "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT",
    "VIRGINIA": "VA", "WASHINGTON": "WA", "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY",
}
# fixed values: the states the second team's files cover
ITEM_STATES = {
    POSTAL[s]: s
    for s in (
        "ARIZONA", "ALASKA", "CALIFORNIA", "COLORADO", "DELAWARE", "FLORIDA", "GEORGIA", "ILLINOIS",
        "MARYLAND", "MICHIGAN", "NEW JERSEY", "NEW MEXICO", "NEVADA", "OHIO", "OREGON", "RHODE ISLAND",
        "TENNESSEE", "TEXAS", "WEST VIRGINIA", "WISCONSIN", "UTAH",
    )
}
