"""Fixed values of the newsletter corpus: names, lists and patterns that results depend on."""

# -- fixed values ------------------------------------------------------------
SCHEMA_VERSION, GENERATOR_VERSION = "1.0.0", "0.1.3"

#: Folder names of sources: this word, or this word and a space before anything else.
SECTOR_WORD = "TLDR"
#: A folder of other mail that must never be among the sources.
FORBIDDEN_SOURCE = "GoDaddy"
SECTOR_ORDER = (
    "tldr",
    "tldr-ai",
    "tldr-dev",
    "tldr-web-dev",
    "tldr-infosec",
    "tldr-cybersecurity",
    "tldr-crypto",
    "tldr-product",
    "tldr-design",
    "tldr-founders",
    "tldr-marketing",
)
LEAD_SECTOR = "tldr"

TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "mc_cid", "mc_eid")
SUBSCRIBER_KEYS = ("email", "subscriber", "subscriber_id")
RAW_SUBSCRIBER_KEYS = ("email", "email_address", "subscriber", "subscriber_id", "contact_id")
CREDENTIAL_KEYS = (
    "access_token", "refresh_token", "id_token", "api_key", "apikey",
    "client_secret", "auth_token", "authorization", "password", "passwd",
    "session", "session_id", "sessionid", "jwt", "signature",
    "x-amz-signature", "x-amz-credential", "x-amz-security-token",
    "x-goog-signature", "x-goog-credential",
)
#: The raw text rules write these keys with underscores.
RAW_CREDENTIAL_KEYS = tuple(k.replace("-", "_") for k in CREDENTIAL_KEYS)
#: Hosts whose credential key is public and only removed, by key.
PUBLIC_CREDENTIALS = {"access_token": ("stratechery.com", "www.stratechery.com")}

NEWS_SITE, NEWS_MAIL_SITE = "tldr.tech", "tldrnewsletter.com"
ACCOUNT_HOSTS = ("hub.sparklp.co", "refer.tldr.tech")
TRAILING_MARKS, RAW_TRAILING_MARKS = ").,;]>\"'", ").,;]"

CLASS_RANK = {"editorial": 0, "resource": 1, "sponsor": 2}
RESOURCE_TYPES = ("github_repo", "course", "tool", "resource", "library", "tutorial", "job")

MATERIAL_WARNINGS = ("dangling_reference", "missing_reference_number", "missing_inline_url", "missing_links_block", "unknown_format", "empty_body")
#: A line that starts with one of these patterns, in any case, starts the footer.
FOOTER_STARTS = (
    "if you don't want to receive",
    "if you have any comments or feedback",
    "thanks for reading",
    "want to advertise",
    "if your company is interested in reaching",
    "we help cutting edge companies hire",
    "click here to unsubscribe",
    "manage your subscription",
    "unsubscribe here",
    "love tldr",
    "tell your friends",
    "tell friends",
    "share tldr",
    "if you are in a hiring position",
    "if you're hiring",
    "hire (?:ai|tech|software)",
    "careers at tldr",
)

PLAN_KEYS = ("front_page", "lead_candidate_id", "section_order", "visual_brief")
BRIEF_1_KEYS = ("alt_text", "central_subject", "composition", "forbidden_elements", "mode", "source_candidate_ids", "visual_metaphor")
BRIEF_2_KEYS = (
    "abstraction_level", "alt_text", "central_subject", "composition", "editorial_idea", "failure_modes",
    "forbidden_elements", "literal_elements", "mode", "schema_version", "source_candidate_ids", "visual_relationship",
)
BRIEF_2_VERSION = "2.0.0"
TEXT_LIMITS = {"editorial_idea": 500, "central_subject": 300, "visual_metaphor": 500, "visual_relationship": 500, "composition": 500, "alt_text": 500}
LIST_LIMITS = {"literal_elements": 12, "forbidden_elements": 20, "failure_modes": 12}
FRONT_PAGE_SIZE, SECONDARY_SIZE, SHORTLIST_CAP = 9, 4, 60

WEBP_QUALITY, WEBP_METHOD = 82, 6
#: How images are asked for and converted; the limits are added by image_configuration.
IMAGE_SETTINGS = {
    "n_policy": "one_explicit_or_endpoint_default",
    "resolution": "1K",
    "aspect_ratio": "3:2",
    "accepted_upstream_formats": ["image/jpeg", "image/png", "image/webp"],
    "provider_webp_when_advertised": True,
    "conversion_version": "1.0.0",
    "conversion": {"mode": "RGB", "format": "webp", "quality": WEBP_QUALITY, "method": WEBP_METHOD, "metadata": "stripped", "animation": False, "background": "opaque_white"},
}
ILLUSTRATION_PROMPT_VERSION = "2.0.0"
IMAGE_SIDES, ASPECT, ASPECT_TOLERANCE = (256, 8192), 1.5, 0.08
RUBRIC_WEIGHTS = (30, 20, 15, 15, 10, 10)
# -- end of fixed values -----------------------------------------------------
