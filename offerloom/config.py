"""Word lists that steer brand and model matching."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field


def fold(s: str | None) -> str:
    """A configuration word as :func:`offerloom.functions.text.norm_text` leaves it."""
    s = unicodedata.normalize("NFKD", (s or "").lower()).encode("ascii", "ignore").decode()
    return " ".join(re.sub(r"[^a-z0-9 /-]", " ", s).split())


@dataclass(frozen=True)
class MatchConfig:
    """Known brands and model phrases with their aliases, folded; brands in order of name, phrases longest first."""

    brands: tuple[str, ...] = ()
    brand_aliases: dict[str, str] = field(default_factory=dict)
    model_phrases: tuple[str, ...] = ()
    model_aliases: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, brands=(), brand_aliases=None, model_phrases=(), model_aliases=None) -> MatchConfig:
        pairs = lambda d: {fold(k): fold(v) for k, v in (d or {}).items()}
        phrases = {fold(p) for p in model_phrases} - {""}
        return cls(tuple(sorted({fold(b) for b in brands} - {""})), pairs(brand_aliases), tuple(sorted(phrases, key=lambda p: (-len(p), p))), pairs(model_aliases))


# Brands, model phrases and words of the tyre trade in Brazil. Stop words are written as folding leaves them (no accents).
KNOWN_BRANDS = (
    "goodyear", "pirelli", "michelin", "dunlop", "bridgestone", "continental", "hankook", "bfgoodrich", "firestone", "kumho", "atras",
    "maxxis", "formula", "yokohama", "toyo", "nitto", "general", "cooper", "falken", "nexen", "sumitomo",
)
MODEL_PHRASES = (
    "kelly edge", "formula evo", "sp touring", "assurance", "maxlife", "efficientgrip", "wrangler", "eagle", "energy", "direction",
    "kelly", "p400 evo", "bc20", "lm704", "enasave ec300", "xl tl primacy", "primacy 4", "f700", "sp sport", "fm800", "eagle sport",
    "p400", "energy xm2",
)
MODEL_STOP_WORDS = (
    "pneu", "pneus", "aro", "tl", "tt", "xl", "runflat", "rft", "reforce", "reforzado", "reforcado", "radial", "tubeless", "tubetype",
    "indice", "indicecarga", "h", "v", "t", "w", "y", "z", "r10", "r12", "r13", "r14", "r15", "r16", "r17", "r18", "r19", "r20",
    "r21", "r22", "82", "84", "86", "88", "90", "91", "92", "94", "95", "97", "99", "100",
)
GENERIC_MODEL_TOKENS = ("pneu", "aro", "radial", "tubeless", "runflat", "xl", "tl", "t", "r", "pro", "sport", "touring", "city", "street")
GENERIC_NAMES = ("p", "produto", "products", "product", "click", "clicks", "count", "item")

DEFAULT = MatchConfig.of(KNOWN_BRANDS, {}, MODEL_PHRASES, {})

# Names of fields in the files of the shops.
#: Column names that stand for each canonical field, the first that exists wins.
COLUMN_ALIASES = {
    "title": ("title", "titulo", "nome", "produto", "product_title"),
    "url": ("url", "link", "href", "page_url", "request_url"),
    "price": ("price", "preco", "valor", "amount"),
    "brand_raw": ("brand_raw", "brand", "marca", "marca_prod", "marca_produto"),
    "model_raw": ("model_raw", "model", "modelo", "modelo_prod", "linha", "linha_modelo"),
    "size_raw": ("size_raw", "size", "tamanho", "medida", "medida_norm"),
    "seller": ("seller", "vendedor", "loja", "store", "seller_name", "store_name"),
    "collected_at": ("collected_at", "data_coleta", "coletado_em", "scrape_date", "scraped_at"),
    "marketplace": ("marketplace", "site", "canal"),
    "source_file": ("source_file", "arquivo", "fonte", "raw_file"),
}
#: Record-level aliases: per row the first value that is not blank wins.
RECORD_ALIASES = {
    "title": ("title", "product_title", "productTitle", "name", "nome", "titulo", "Title"),
    "price": ("price", "preco", "product_price", "valor", "salePrice", "sellingPrice", "bestPrice", "final_price", "Price"),
    "seller": ("seller", "sellerName", "seller_name", "loja", "store", "merchant", "vendor"),
    "url": ("url", "link", "product_url", "productUrl", "urlProduto", "url_produto", "href", "Url"),
    "sku": ("sku", "product_id", "productId", "code", "identifier", "id", "Id"),
    "stock": ("stock", "estoque", "quantity", "availableQuantity", "available_quantity"),
    "location": ("location", "cidade", "city"),
    "currency": ("currency", "moeda", "currency_id", "Currency"),
    "condition": ("condition", "condicao", "Condition"),
    "shipping_price": ("shipping_price", "frete", "shipping", "frete_price"),
    "captured_at": ("captured_at", "scraped_at"),
}
