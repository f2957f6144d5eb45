"""Fixed values of the movie-rating data set and of the drift rules."""

# Allowed values in the raw tables.
RATINGS = [1, 2, 3, 4, 5]
GENDERS = ["M", "F"]
AGES = [1, 18, 25, 35, 45, 50, 56]
OCCUPATIONS = list(range(21))
GENRES = [
    "Action", "Adventure", "Animation", "Children's", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical",
    "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
]
AGE_LABELS = {1: "<18", 18: "18-24", 25: "25-34", 35: "35-44", 45: "45-49", 50: "50-55", 56: "56+"}

# A rating at or above this is a like.
LIKE_AT = 4

# Values put in for a profile or an item that lacks them.
PROFILE_DEFAULTS = {"user_avg_rating": 3.5, "user_n_ratings": 20.0, "user_std_rating": 1.0}
ITEM_DEFAULTS = {"movie_avg_rating": 3.5, "movie_n_ratings": 10.0}
UNKNOWN_YEAR = 2000.0

# Drift limits.
PSI_ORANGE = 0.10
PSI_RED = 0.25
P_LIMIT = 0.05
RETRAIN_OVER = 0.3
SHIFT_ORANGE = 0.15
SHIFT_RED = 0.25
P99_LIMIT_MS = 500.0
EMPTY_SHARE = 0.001
MIN_VALUES = 10

# Quality limits.
MIN_ROWS = 1000
MAX_NULL_RATE = 0.05
POSITIVE_RANGE = (0.10, 0.90)
MAX_DUPLICATE_SHARE = 0.01

# Promotion limits: metric, comparison, limit.
GATE = [
    ("accuracy", ">=", 0.60),
    ("f1_score", ">=", 0.50),
    ("roc_auc", ">=", 0.52),
    ("cv_std", "<=", 0.05),
    ("separation", ">=", 0.005),
    ("train_test_gap", "<=", 0.20),
]

# Model settings compared with each other: name, smoothing, alpha, two weights.
RUNS = [
    ("baseline", 1e-2, 1.0, 0.6, 0.4),
    ("high_smoothing", 1e-1, 1.0, 0.6, 0.4),
    ("genre_dominant", 1e-2, 0.5, 0.3, 0.7),
]
