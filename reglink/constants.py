"""Fixed values.

These must equal the reference's for the same results; they are stated
here once, in natural order, and imported everywhere else.
"""

# --- fixed values -----------------------------------------------------------
ADDRESS_THRESHOLD = 80        # token_set_ratio(address, block or pin) >= 80
NAME_THRESHOLD = 0.9          # name and father's name similarity >= 0.9
CHUNK_SIZE = 100              # pending records per chunk

ADDRESS_SEPARATOR = ","       # join of the address parts

ELAPSED_HOUR = " Hour "
ELAPSED_MINUTES = " Minutes "
ELAPSED_SECONDS = " Seconds"

UPLOAD_DROPPED_COLUMNS = ["DEATH_SPOUSE_NAME", "DEATH_DATE", "DEATH_BASE_REGN_DATE", "DEATH_AGE_YEAR", "DEATH_SEX"]
UPLOAD_ADDRESS_COLUMNS = ["DEATH_RESIDENCE", "DEATH_RESIDENCE_STREET", "DEATH_RESIDENCE_PREMISES",
                          "DEATH_RESIDENCE_DIST", "DEATH_RESIDENCE_STATE"]
# ---------------------------------------------------------------------------
