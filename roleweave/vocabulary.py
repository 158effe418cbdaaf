"""The word lists and domains that results must agree on."""

# Regex fragments that make a posting relevant.
INCLUDE = (
    "bioinformatic(?:s|ian|ist)",
    "computational biolog(?:y|ists?)",
    "clinical bioinformatics",
    "genomics data scientist",
    "genomics data engineer",
    "hybrid capture",
    "targeted sequencing",
    "CNV calling",
    "fusion[- ]?(calling|detection)",
    "translocation",
    "MSI",
    "TMB",
    "HRD",
    "liquid biopsy",
    "cfDNA",
    "FFPE",
    "oncology NGS",
    "clinical genomics",
    "variant calling",
    "somatic variant",
    "NGS",
    "next[- ]generation sequencing",
    "single[- ]cell",
    "transcriptomics",
    "common workflow language",
    "CWL",
    "Nextflow",
    "AWS HealthOmics",
    "bioinformatics pipeline",
    "pipeline architect",
    "GATK",
    "Mutect2",
    "PureCN",
    "CNVkit",
    "BWA",
    "STAR",
    "microbiome",
    "metagenomics",
    "comparative genomics",
    "antibiotic resistance",
    "experimental evolution",
    "regulatory genomics",
    "transcription factor binding",
)

# Regex fragments that make a posting irrelevant wherever they occur.
EXCLUDE = ("data entry",)

# Title fragments that switch off the description fallback.
OFF_TOPIC_TITLES = (
    "sales",
    "account executive",
    "marketing",
    "business development",
    "investor relations",
    "communications manager",
    "recruiter",
    "talent acquisition",
    "human resources",
    "mechanical engineer",
)

# Domains.
SOURCES = ("greenhouse", "lever", "ashby", "workday", "jobspy")
STATUSES = ("new", "applied", "skip")
STATUS_FILTERS = ("new", "applied", "skip", "all")
REMOTE_FILTERS = ("remote", "onsite")
BOARD_TYPES = ("greenhouse", "lever", "ashby")

# Public careers page of a board, by board type.
CAREERS_URL = {
    "greenhouse": "https://job-boards.greenhouse.io/%s",
    "lever": "https://jobs.lever.co/%s",
    "ashby": "https://jobs.ashbyhq.com/%s",
}

# A listing page shorter than this ends the listing.
LISTING_PAGE_SIZE = 20

# Default search plan of the aggregator feed.
SEARCH_SITES = ("linkedin", "indeed", "zip_recruiter", "glassdoor", "google")
SEARCH_TERMS = ("bioinformatics scientist", "computational biologist")
SEARCH_LOCATIONS = ("United States",)
RESULTS_WANTED = 30
HOURS_OLD = 72

# Put before every text that is embedded, so all vectors share one space.
EMBEDDING_PREFIX = "search_document: "
EMBEDDING_BATCH = 8

# English words that carry no content.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
    himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
    haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
    weren weren't won won't wouldn wouldn't
    """.split()
)
