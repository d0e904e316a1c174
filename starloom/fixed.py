"""Physical constants, fill values and published thresholds.

Results are only comparable when these match the published data sets, so they
are stated once, here, and nowhere else.
"""

# Units.
LIGHT_YEARS_PER_PARSEC = 3.261563777
ARCSEC_PER_MAS = 0.001

# Merging of colour and photometry columns.
FILL_COLOUR = 1.0
FILL_MAGNITUDE = 20.0
PHOTOMETRY_OFFSET = 0.25
FILL_G_MAGNITUDE = 10.0

# Quality limits (parallax over its error) and file gate.
INGEST_SNR = 2.0
LOAD_SNR = 5.0
EXPORT_SNR = 5.0
MIN_ROWS_PER_FILE = 20_000
MAX_ROWS_PER_SET = 50_000_000
SLICES_PER_SET = 100

# Star sets as (parallax over error above, distance below, magnitude below).
SET_THRESHOLDS = (
    (20, 5000, 15),
    (20, 10000, 15),
    (30, 5000, 15),
    (40, 3000, 15),
    (80, 2000, 15),
    (50, 2000, 10),
    (20, 3000, -1),
    (50, 4000, -1),
    (50, 5000, -2),
    (40, 5000, -2),
    (30, 5000, -2),
    (20, 10000, -3),
    (10, 20000, -3),
)

# Threshold grid.
GRID_SNR = (200, 150, 100, 80, 50, 40, 30, 20, 10, 5)
GRID_DIST = (500, 1000, 2000, 3000, 4000, 5000, 10000, 20000, 30000, 50000, 100000, 250000)
GRID_MAG = (-7, -5, -3, -2, -1, 0, 1, 2, 3, 4, 5, 6, 8, 10, 15)
GRID_MIN_ROWS = 1_000_000
GRID_MAX_ROWS = 50_000_000
GRID_PLATEAU = 0.9

# Neighbourhood boxes (relative and absolute margin, light years).
BOX_RELATIVE = 0.1
BOX_MARGIN = 150.0

# Display window and display formulas.
RENDER_NEAR, RENDER_FAR, RENDER_MAG = 3000.0, 70000.0, -5.0
WIEN_SCALE = 2.8977719
TEMPERATURE_FACTOR = 1.5
DIM_SPAN, DIM_CENTRE, DIM_FLOOR = 900.0, 8.0, 0.1
SIZE_FLOOR, SIZE_CEILING = 0.2, 3.0
RED_SCALE, RED_POWER = 329.698727446, -0.1332047592
GREEN_SCALE, GREEN_SHIFT = 99.4708025861, 161.1195681661
GREEN_HOT_SCALE, GREEN_HOT_POWER = 288.1221695283, -0.0755148492
BLUE_SCALE, BLUE_SHIFT = 138.5177312231, 305.0447927307

# Bins below this normalised value may be cut; endpoint colours of the blend.
BIN_CUT = 0.05
BLEND_LOW, BLEND_HIGH = (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)

# Decimals that exported numbers keep, and digits ahead of the point from which it is fewer.
CUT_NARROW, CUT_WIDE, CUT_WIDE_FROM = 3, 1, 3
