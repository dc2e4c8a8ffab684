"""Fixed values that results depend on, stated once in natural order."""

# English stop words (the widely used 179-word English list).
STOPWORDS_EN = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]

# Common English contractions and their expansions (our list; whole tokens).
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot", "couldn't": "could not",
    "didn't": "did not", "doesn't": "does not", "don't": "do not", "hadn't": "had not",
    "hasn't": "has not", "haven't": "have not", "he's": "he is", "i'd": "i would",
    "i'll": "i will", "i'm": "i am", "i've": "i have", "isn't": "is not", "it's": "it is",
    "let's": "let us", "shouldn't": "should not", "that's": "that is", "there's": "there is",
    "they're": "they are", "they've": "they have", "wasn't": "was not", "we're": "we are",
    "we've": "we have", "weren't": "were not", "what's": "what is", "won't": "will not",
    "wouldn't": "would not", "you'd": "you would", "you'll": "you will", "you're": "you are",
    "you've": "you have",
}

# Credit-rating scale: class position (0-21) -> rating; rating rank -> rating
# and grade (ranks skip 21 and 22).
CLASS_RATINGS = ["AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+",
                 "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "SD", "D"]
RATING_RANKS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 23, 24]
INVESTMENT_GRADE_MAX_RANK = 10   # ranks 1-10 investment grade, the rest high yield

# Ten model features of the US rating forest (quarterly ratios and industry).
RATING_FEATURES_US = ["intcov_ratioq", "lt_debtq", "inv_turnq", "gind", "int_totdebtq",
                      "lt_ppentq", "opmbdq", "short_debtq", "debt_atq", "invt_actq"]

# Ten model features of the global rating forest (country rank, industry and
# quarterly ratios).
RATING_FEATURES_GLB = ["loc_rank", "gind", "intcov_ratioq", "int_totdebtq", "gpmq", "lt_ppentq",
                       "lt_atq", "inv_turnq", "invt_actq", "rect_turnq"]
