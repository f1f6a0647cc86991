"""The seven small catalogue tables as text rows; a backslash-N is a null."""

N = r"\N"

TITLES = [
    ("t1", "Alpha", "movie", "0", "2000", "29", "Drama,Comedy"),
    ("t2", "Beta", "movie", "0", "2000", "30", "Drama"),
    ("t3", "Gamma", "tvSeries", "0", "2002", "60", "Comedy"),
    ("t4", "Delta", "movie", "1", "2002", "90", "Drama"),
    ("t5", "Epsilon", "movie", "0", "2002", "121", "Drama"),
    ("t6", "Zeta", "short", "0", N, N, "Horror"),
    ("t7", 'Eta, "Two"', "movie", "0", "2001", "n/a", N),
    ("t8", "Theta", "tvSeries", "0", "2001", "120", "Drama,Horror"),
]
RATINGS = [
    ("t1", "8.0", "100"),
    ("t2", "2.0", "10"),
    ("t3", "8.0", "50"),
    ("t4", "9.9", "5"),
    ("t6", "10.0", "7"),
    ("t7", "4.0", "3"),
    ("t8", "6.0", "60"),
]
CREW = [
    ("t1", "n1,n2", "n3"),
    ("t2", "n1", N),
    ("t3", "n2", "n3,n4"),
    ("t5", "n1", "n4"),
    ("t8", N, "n3"),
]
PRINCIPALS = [
    ("t1", "n1", "director", N),
    ("t1", "n5", "producer", "producer"),
    ("t1", "n5", "producer", "executive"),
    ("t1", "n3", "writer", "story"),
    ("t1", "n3", "writer", "screenplay"),
    ("t2", "n1", "director", N),
    ("t2", "n5", "producer", "producer"),
    ("t3", "n4", "writer", N),
    ("t8", "n1", "writer", N),
]
AKAS = [
    ("t1", "US", "en"),
    ("t1", "FR", "fr"),
    ("t1", N, N),
    ("t2", "US", N),
    ("t3", "None", "en"),
    ("t9", "US", "en"),
]
NAMES = [("n1", "Ann"), ("n2", "Bea"), ("n3", "Cid"), ("n4", "Dan"), ("n5", "Eva")]
EPISODES = [("t10", "t3"), ("t11", "t8")]

COLUMNS = {
    "titles": "tconst primaryTitle titleType isAdult startYear runtimeMinutes genres",
    "ratings": "tconst averageRating numVotes",
    "crew": "tconst directors writers",
    "principals": "tconst nconst category job",
    "akas": "titleId region language",
    "names": "nconst primaryName",
    "episodes": "tconst parentTconst",
}
ROWS = {
    "titles": TITLES,
    "ratings": RATINGS,
    "crew": CREW,
    "principals": PRINCIPALS,
    "akas": AKAS,
    "names": NAMES,
    "episodes": EPISODES,
}
