"""Defaults of the pipeline's parameters. Every function takes them as arguments."""

MAX_POSTS = 100
ON_DEMAND_MAX_POSTS = 25
COMMENT_LIMIT = 100
MIN_POST_CHARS = 30
DATA_TTL_HOURS = 6
INDEX_WINDOW_DAYS = 30
TOP_K = 5
MIN_RELEVANCE = 0.75
MEMORY_TURNS = 5
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
PREVIEW_ROWS = 50
REMOVED_MARKERS = ("[deleted]", "[removed]")
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
