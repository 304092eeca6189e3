"""Mentions of products and titles of codes, cut down to what tells them apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of dosing that no product's name has, words of route or form with the form
# words that they imply, and words of titles that tell nothing.
DOSING = """bid tid qid qd qod qhs qam qpm qh prn stat q2h q4h q6h q8h q12h q24h ac pc hs
x lần liều ngày mỗi sau trước khi cần và
daily once twice thrice every other day days week weekly month monthly night nightly morning
evening hour hours hr hrs minute minutes min at in as needed per then now home tại nhà
hàng buổi sáng tối chiều đơn vị""".split()
FORMS = {
    "po": ["oral"], "uống": ["oral"], "đường": [], "miệng": ["oral"],
    "viên": ["tablet"], "nén": ["tablet"], "nang": ["capsule"],
    "iv": ["injection", "injectable"], "im": ["injection", "injectable"], "sc": ["injection", "injectable"], "tiêm": ["injection", "injectable"],
    "tĩnh": ["injection", "injectable"], "mạch": [], "truyền": ["injection", "injectable"],
    "sl": ["sublingual"], "lưỡi": ["sublingual"], "dưới": [],
    "hít": ["inhalation"], "xịt": ["spray", "inhalation"], "khí": ["inhalation"],
    "bôi": ["topical"], "thoa": ["topical"], "nhỏ": ["drop", "ophthalmic"], "đặt": [], "hậu": ["rectal"], "môn": [],
    "oral": ["oral"], "tablet": ["tablet"], "capsule": ["capsule"],
    "solution": ["solution"], "suspension": ["suspension"], "syrup": ["syrup"],
    "injection": ["injection", "injectable"], "injectable": ["injection", "injectable"],
    "sublingual": ["sublingual"], "topical": ["topical"], "inhalation": ["inhalation"],
    "cream": ["cream"], "ointment": ["ointment"], "patch": ["patch"],
    "tab": ["tablet"], "tabs": ["tablet"], "cap": ["capsule"], "caps": ["capsule"],
    "neb": ["inhalation", "solution"], "nebs": ["inhalation", "solution"],
    "puff": ["inhalation"], "puffs": ["inhalation"], "nhồi": ["inhalation"],
}
TITLE_STOPWORDS = """bệnh hội chứng do và của khác không kèm theo được phân loại nơi hoặc ở tại với các một
này đó the of and in to phần vùng thể""".split()
DOSE = r"(?U)\d\s*(?:mg|mcg|ug|g|gram|gm|ml|l|iu|unit|units|%)\b|\d+\s*/\s*\d"
WORD_RANGE = "0-9a-zà-ỹ"


def has_dose(text: Column) -> Column:
    """Whether a lower-case text names an amount with a unit, or a ratio."""
    return text.rlike(DOSE)


def title_tokens(name: Column, stopwords: list[str] = TITLE_STOPWORDS) -> Column:
    """The distinct tokens of a normalised title, one-letter ones too, without ``stopwords``."""
    found = F.regexp_extract_all(name, F.lit(f"(?iu)([{WORD_RANGE}]+)"), 1)
    return F.array_except(found, F.array(*(F.lit(w) for w in stopwords)).cast("array<string>"))


def product_core(key: Column, forms: dict[str, list[str]] = FORMS, dosing: list[str] = DOSING) -> tuple[Column, Column]:
    """(core, hints) of a normalised mention: its tokens but for route, form and dosing, joined
    by blanks, and the sorted form words that those imply.

    Asides in parentheses go, an open one to the end.  A token falls apart at colons, semicolons
    and commas, and at slashes if all its sides are such words, so units stay whole; it goes if
    all its parts are.  A null key gives nulls, one without a token an empty core and no hints.
    """
    known = lambda w: w.isin(*forms, *dosing)
    some = lambda xs: F.filter(xs, lambda x: x != "")

    def parts(token: Column) -> Column:
        bare = some(F.transform(F.split(token, "[:;,]"), lambda p: F.regexp_replace(p, f"[^{WORD_RANGE}/.%]+", "")))
        sides = lambda p: some(F.split(p, "/"))
        return F.flatten(F.transform(bare, lambda p: F.when((F.size(sides(p)) > 1) & F.forall(sides(p), known), sides(p)).otherwise(F.array(p))))

    tokens = F.transform(some(F.split(F.regexp_replace(key, "\\([^)]*\\)?", " "), "(?U)\\s+")), parts)
    core = F.array_join(F.flatten(F.filter(tokens, lambda ps: ~F.forall(ps, known))), " ")
    implied = F.create_map(*(x for w, fs in forms.items() for x in (F.lit(w), F.array(*(F.lit(f) for f in fs)).cast("array<string>"))))
    gone = F.flatten(F.filter(tokens, lambda ps: F.forall(ps, known)))
    hints = F.flatten(F.filter(F.transform(gone, lambda w: F.try_element_at(implied, w)), lambda fs: fs.isNotNull()))
    return core, F.array_sort(F.array_distinct(hints))
