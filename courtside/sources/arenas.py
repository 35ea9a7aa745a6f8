"""The home arena of each team."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from courtside.schema import ARENA_DIMENSION

# Team id, tricode, arena, city, state.
ARENAS = """
1610612737|ATL|State Farm Arena|Atlanta|GA
1610612738|BOS|TD Garden|Boston|MA
1610612739|CLE|Rocket Arena|Cleveland|OH
1610612740|NOP|Smoothie King Center|New Orleans|LA
1610612741|CHI|United Center|Chicago|IL
1610612742|DAL|American Airlines Center|Dallas|TX
1610612743|DEN|Ball Arena|Denver|CO
1610612744|GSW|Chase Center|San Francisco|CA
1610612745|HOU|Toyota Center|Houston|TX
1610612746|LAC|Crypto.com Arena|Los Angeles|CA
1610612747|LAL|Crypto.com Arena|Los Angeles|CA
1610612748|MIA|Kaseya Center|Miami|FL
1610612749|MIL|Fiserv Forum|Milwaukee|WI
1610612750|MIN|Target Center|Minneapolis|MN
1610612751|BKN|Barclays Center|Brooklyn|NY
1610612752|NYK|Madison Square Garden|New York|NY
1610612753|ORL|Kia Center|Orlando|FL
1610612754|IND|Gainbridge Fieldhouse|Indianapolis|IN
1610612755|PHI|Wells Fargo Center|Philadelphia|PA
1610612756|PHX|Footprint Center|Phoenix|AZ
1610612757|POR|Moda Center|Portland|OR
1610612758|SAC|Golden 1 Center|Sacramento|CA
1610612759|SAS|Frost Bank Center|San Antonio|TX
1610612760|OKC|Paycom Center|Oklahoma City|OK
1610612761|TOR|Scotiabank Arena|Toronto|ON
1610612762|UTA|Delta Center|Salt Lake City|UT
1610612763|MEM|FedExForum|Memphis|TN
1610612764|WAS|Capital One Arena|Washington|DC
1610612765|DET|Little Caesars Arena|Detroit|MI
1610612766|CHA|Spectrum Center|Charlotte|NC
"""


def arena_rows(spark: SparkSession, updated_at: datetime) -> DataFrame:
    fields = (line.split("|") for line in ARENAS.strip().splitlines())
    rows = [(int(team), *rest, updated_at) for team, *rest in fields]
    return spark.createDataFrame(rows, ARENA_DIMENSION)
