"""Fixed values that must equal the source application's for equal results.

FIXED VALUES - kept exactly as the application states them, in its order.
"""

# --- FIXED VALUES: user trait domains, in the order the request form lists them ---
AGE = ['18 & Under', '19-24', '25-29', '30-35', '36-43', '44-55', '56 & Over', 'Unknown']
SKIN_TYPE = ['Acne-prone', 'Combination', 'Dry', 'Normal', 'Oily', 'Other', 'Sensitive',
             'Very Dry', 'Very Oily']
SKIN_TONE = ['Dark', 'Deep Dark', 'Fair', 'Fair-Medium', 'Medium', 'Medium Brown', 'Olive',
             'Other', 'Tan']
SKIN_UNDERTONE = ['Cool', 'Neutral', 'Not Sure', 'Warm']
HAIR_COLOR = ['Black', 'Blond', 'Brown', 'Brunette', 'Grey', 'Other', 'Red', 'Silver']
HAIR_TYPE = ['Curly', 'Kinky', 'Other', 'Relaxed', 'Straight', 'Wavy']
HAIR_TEXTURE = ['Coarse', 'Fine', 'Medium', 'Other']
EYES = ['Black', 'Blue', 'Brown', 'Green', 'Grey', 'Hazel', 'Other', 'Violet']

# --- FIXED VALUES: trait columns in table order, and the request-vector slot offsets ---
TRAITS = ['age', 'eyes', 'skin_type', 'skin_tone', 'skin_undertone',
          'hair_color', 'hair_type', 'hair_texture']
TRAIT_DOMAINS = {
    'age': AGE, 'eyes': EYES, 'skin_type': SKIN_TYPE, 'skin_tone': SKIN_TONE,
    'skin_undertone': SKIN_UNDERTONE, 'hair_color': HAIR_COLOR, 'hair_type': HAIR_TYPE,
    'hair_texture': HAIR_TEXTURE,
}
SLOT_OFFSETS = {'age': 0, 'eyes': 8, 'skin_type': 16, 'skin_tone': 25, 'skin_undertone': 34,
                'hair_color': 38, 'hair_type': 46, 'hair_texture': 52}

# --- FIXED VALUES: review categories (id -> name), as the cleaning step lists them ---
CATEGORY_IDS = ['705', '702', '701', '707', '703', '708', '709', '704', '706']
CATEGORY_NAMES = ['Treatments (Face)', 'Toners', 'Cleansers', 'Moisturizers', 'Masks',
                  'Eye Makeup Remover', 'Neck/Decollete Cream', 'Scrubs', 'Treatments (Eye)']

# --- FIXED VALUES: ingredient delimiters, ordered alternation (Python regex text) ---
INGREDIENT_DELIMITERS = [
    ',', 'and', r'\.+', ':', '/', r'\s-+\s', r'\*+', r'\[\]', r'\a', r'\n', r'\t', r'\s\s+',
    'â\u0080¢', ';', '-+', '_+',
    r'active\singredients', r'also\scontains', r'rapid\sactivation\sgel', r'step\s1',
    r'step\s2', r'step\s3',
    r'active\singredient', r'inactive\singredients', r'inactive\singredient',
    r'other\singredients',
    'ingredients', 'ingredient', r'previous\singredients', 'others', 'other',
]

# --- FIXED VALUES: page-link markers, search-URL path, crawl limits ---
PRODUCT_LINK_MARKER = '/product/showreview.asp/ItemId='
BRAND_LINK_MARKER = '/product/searching.asp/Brand='
SEARCH_PATH_TEMPLATE = ('/product/searching.asp/CategoryId={}/NumberOfReviews=5/SD=DESC/'
                        'SC=HOWMANY/page=')
SKIPPED_REVIEW_URL = '/product/showreview.asp/ItemId=4375/page=67'
MAX_SEARCH_PAGES = 66
REVIEWS_PER_PAGE = 10

# --- FIXED VALUES: model settings ---
ALS_RANKS = [10, 20, 50]
ALS_REG_PARAMS = [.05, .1, .15]
ALS_FOLDS = 5
SAMPLE_SIZE = 10
SAMPLE_SEED = 123

# FIXED VALUES: columns of the rating and content tables
RATING_COLS = ["pro_ids", "users", "lipies"]
CONTENT_COLS = ["names", "pro_ids", "ratings", "repurchases", "pkg_quals", "prices",
                "ingredients", "brands"]
