"""Run parameters. Defaults are the fixed values of the benchmark recipe."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the recipe being reproduced.
N_BOOKS = 1                  # accepted books per language
N_PAGES = 20                 # pages an accepted book must keep
N_FRONT_MANDATORY = 3        # first chunks always sampled
STRATA = (("front", 2), ("body", 10), ("back", 5))  # zone -> pages drawn
MIN_MD_CHARS = 150           # smallest chunk / section kept for splitting
MIN_SECTION_CHARS = 50       # smallest converted section kept
PAGE_CHARS = 2800            # paragraph-packing block size
MAX_HEADING_WORDS = 20       # longer styled blocks are not promoted
BATCH_SIZE = 8               # pages per model call
LANGUAGES = (("italian", "it"), ("german", "de"))


@dataclass(frozen=True)
class Params:
    n_books: int = N_BOOKS
    n_pages: int = N_PAGES
    n_front_mandatory: int = N_FRONT_MANDATORY
    strata: tuple = STRATA
    min_md_chars: int = MIN_MD_CHARS
    min_section_chars: int = MIN_SECTION_CHARS
    page_chars: int = PAGE_CHARS
    max_heading_words: int = MAX_HEADING_WORDS
    batch_size: int = BATCH_SIZE
    seed: str = "42"
    languages: tuple = field(default=LANGUAGES)

    @property
    def strata_map(self) -> dict:
        return dict(self.strata)
