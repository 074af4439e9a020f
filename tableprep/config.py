"""Configuration of the listing-preparation job.

Fixed values: the lists, thresholds and patterns below must equal the ones the
original listing pipeline used, otherwise results differ. They are stated
plainly and together, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
CANDIDATE_SENTINELS = ['-', '', 'N/A', 'n/a', 'NA', 'None', 'none', 'NULL', 'null',
                       'nan', 'NAN', '--', 'NIL', '?', 'unknown', 'Unknown', ' ']

# Texts that a loader takes for missing, before any cleaning rule sees them.
LOAD_MISSING = ['', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
                '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null']

VALID_STATES = ['Selangor', 'Penang', 'Kuala Lumpur', 'Johor', 'Sabah', 'Sarawak',
                'Perak', 'Kedah', 'Pahang', 'Negeri Sembilan', 'Melaka',
                'Terengganu', 'Kelantan', 'Perlis', 'Putrajaya', 'Labuan']

REFERENCE_YEAR = 2023
FLOOR_MAX = 78
Z_THRESHOLD = 3
IQR_K = 1.5
CHI2_P = 0.975
BEDROOM_LIMIT = 8
PARKING_LIMIT = 4
PARKING_PRICE_SHARE = 0.5
RARE_STATE_THRESHOLD = 10
RARE_PROPERTY_TYPE_THRESHOLD = 20
TEST_FRACTION = 0.2
SPLIT_SEED = 42
DIGIT_SHIFT_FACTORS = [10, 100, 1000]
DIGIT_SHIFT_TOLERANCE = 0.05
SIZE_MIN_PLAUSIBLE = 100          # notes: sizes under 100 sq.ft. are extraction failures

LAND_TITLE_MERGE = {'Malay Reserved': 'Bumi Lot'}
LAND_TITLE_MAP = {'Non Bumi Lot': 1, 'Bumi Lot': 0}
TENURE_MAP = {'Freehold': 1, 'Leasehold': 0}
FLOOR_RANGE_ORDER = ['Low', 'Medium', 'High']

# Regular expressions (Java syntax; (?i) = case-insensitive).
PRICE_PREFIX = 'RM'
SIZE_UNIT_PATTERN = r'([\d,]+(?:\.\d+)?)\s*sq\.ft\.'
SIZE_PATTERN = r'(?i)(\d[\d,]*\.?\d*)\s*(?:sq\.?\s*ft\.?|sqft|square\s*feet|sf)(?!\w)'
LAND_AREA_PATTERN = r'(?i)Land\s*Area\s*[:\-]?\s*(\d[\d,]*\.?\d*)\s*sq\.?\s*ft'
BEDROOM_PATTERN = r'(?i)(\d+)\s*bed\s*rooms?\b'
BATHROOM_PATTERN = r'(?i)(\d+)\s*bath\s*rooms?\b'
BEDROOM_STRICT_PATTERN = r'(?i)(\d+)[^\S\n]*-?[^\S\n]*bed[^\S\n]*-?[^\S\n]*rooms?\b'
TRAILING_TEN = r',\s*10\s*$'
DIGITS_ONLY = r'[^0-9]'
FIRST_DECIMAL = r'(-?\d+\.?\d*)'
# ---------------------------------------------------------------------------

# A plain decimal number, as pandas' to_numeric accepts it (outer spaces, sign,
# exponent). Java's parser would also take '1d' / '1f'; this guard refuses them.
NUMERIC_TEXT = r'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'


@dataclass(frozen=True)
class ListingColumns:
    """Column roles of the listing table (names in the driver's `listings` view)."""
    key: str = 'ad_id'
    text: str = 'description'
    price: str = 'price'
    size: str = 'property_size'
    bedroom: str = 'bedroom'
    bathroom: str = 'bathroom'
    year: str = 'completion_year'
    floors: str = 'floors'
    units: str = 'total_units'
    parking: str = 'parking_lot'
    address: str = 'address'
    facilities: str = 'facilities'
    property_type: str = 'property_type'
    floor_range: str = 'floor_range'
    tenure: str = 'tenure_type'
    land_title: str = 'land_title'
    nearby: tuple = ('school', 'mall')
    dropped_no_engineering: tuple = ('description', 'ad_id', 'nearby_school')
    numeric: tuple = ('bedroom', 'bathroom', 'completion_year', 'floors', 'total_units', 'parking_lot')


@dataclass(frozen=True)
class PrepareConfig:
    cols: ListingColumns = field(default_factory=ListingColumns)
    sentinels: tuple = tuple(CANDIDATE_SENTINELS)
    out_of_scope_type: str = 'Others'
    test_fraction: float = TEST_FRACTION
    seed: int = SPLIT_SEED
    floor_max: float = FLOOR_MAX
    size_min: float = SIZE_MIN_PLAUSIBLE
    z: float = Z_THRESHOLD
    fit_scope: str = 'each'        # the code re-fits z per split for the size rule
    rare_state: int = RARE_STATE_THRESHOLD
    rare_type: int = RARE_PROPERTY_TYPE_THRESHOLD
    reference_year: int = REFERENCE_YEAR
    exact_split: bool = False      # True: the test side has exactly ceil(test_fraction * n) keys
    max_columns: int = 1000        # of one encoder; a longer category list gives one sparse column
    # features without a fill rule; any other missing cell in the result fails the job
    may_miss: tuple = ('bedroom', 'bathroom', 'Is_Non_Bumi_Lot', 'Freehold_Indicator')
