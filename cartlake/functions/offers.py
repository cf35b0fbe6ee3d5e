"""Which offer a cart gets, and what the offer is expected to recover."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlake.functions.profiles import BARGAIN_HUNTER, HIGH_INTENT
from cartlake.functions.risk import (
    HIGH_RISK_BELOW,
    LOW_RISK_BELOW,
    MODERATE_RISK_BELOW,
    predicted_abandoned,
    real,
)

NO_COUPON = "NENHUM"

# The seven outcomes of the risk x value matrix.
# code, label, discount as a fraction, free shipping, urgency, rationale
COUPON_OFFERS = [
    (
        "NENHUM",
        "Sem Cupom Necessário",
        0.0,
        False,
        "Baixa",
        "Cliente apresenta alta intenção de compra orgânica. Oferta de cupom iria erodir margem desnecessariamente.",
    ),
    (
        "FRETE_GRATIS",
        "Frete Grátis Shopee",
        0.0,
        True,
        "Média",
        "Risco moderado em carrinho de médio/alto valor. O benefício do frete grátis elimina a principal barreira de checkout.",
    ),
    (
        "DESC5",
        "Cupom 5% OFF",
        0.05,
        False,
        "Média",
        "Risco moderado em carrinho de ticket menor. Desconto leve de 5% incentiva a finalização imediata.",
    ),
    (
        "DESC10",
        "Cupom 10% OFF Especial",
        0.10,
        False,
        "Alta",
        "Alto risco de perda de carrinho de valor expressivo. Cupom de 10% OFF atua como forte gatilho de conversão.",
    ),
    (
        "DESC5_FRETE",
        "Cupom 5% OFF + Frete Grátis",
        0.05,
        True,
        "Alta",
        "Alto risco em ticket intermediário. Combo de 5% + Frete Grátis oferece percepção de alto valor para o cliente.",
    ),
    (
        "RECUPE15",
        "Cupom 15% VIP Recuperação",
        0.15,
        True,
        "Crítica",
        "Abandono iminente em carrinho de altíssimo valor (GMV). Recuperação agressiva com 15% OFF + Frete Grátis preserva receita substancial.",
    ),
    (
        "DESC10_FRETE",
        "Cupom 10% OFF + Frete Grátis",
        0.10,
        True,
        "Crítica",
        "Carrinho prestes a ser abandonado. Incentivo máximo de 10% OFF + Frete Grátis para salvar a transação.",
    ),
]
OFFER_SCHEMA = (
    "coupon_code string, coupon_label string, discount_pct double, "
    "free_shipping boolean, urgency_level string, rationale string"
)

# The outcomes of the profile x value prescription.
# profile, shown name, code, label, discount, free shipping, urgency, rationale
PROFILE_OFFERS = [
    (
        "high_intent",
        "1. Comprador de Alta Intenção",
        "FRETE_GRATIS",
        "Frete Grátis Shopee",
        0.0,
        True,
        "Média",
        "Cliente com alta intenção orgânica. Evita dar desconto agressivo para proteger margem financeira.",
    ),
    (
        "high_intent",
        "1. Comprador de Alta Intenção",
        "LEMBRETE_SEM_DESCONTO",
        "Apenas Lembrete (Sem Cupom)",
        0.0,
        False,
        "Média",
        "Cliente com alta intenção orgânica. Evita dar desconto agressivo para proteger margem financeira.",
    ),
    (
        "bargain_hunter",
        "2. Caçador de Descontos",
        "DESC15_VIP",
        "Cupom 15% VIP Recuperação",
        0.15,
        True,
        "Alta",
        "Cliente altamente sensível a preço/ofertas. Cupom de alto valor destrava a tomada de decisão.",
    ),
    (
        "bargain_hunter",
        "2. Caçador de Descontos",
        "DESC10_FRETE",
        "Cupom 10% OFF + Frete Grátis",
        0.10,
        True,
        "Alta",
        "Cliente altamente sensível a preço/ofertas. Cupom de alto valor destrava a tomada de decisão.",
    ),
    (
        "browser",
        "3. Navegador Indeciso",
        "DESC5_FRETE",
        "Cupom 5% OFF + Frete Grátis",
        0.05,
        True,
        "Média",
        "Cliente navega por indecisão. Combo leve de 5% + Frete Grátis elimina a barreira do checkout.",
    ),
]
PROFILE_OFFER_SCHEMA = (
    "user_profile string, profile_name_pt string, coupon_code string, coupon_label string, "
    "discount_pct double, free_shipping boolean, urgency_level string, rationale string"
)

# Order of urgency, expected lift of an offer, streaming share.
URGENCY_ORDER = ["Crítica", "Alta", "Média", "Baixa"]
LIFT = 0.35
STREAM_SHARE = 0.85

# Value from which a tier or profile gets its first offer.
# upper risk bound, value threshold, offer from the threshold on, offer below it
MATRIX = [
    (MODERATE_RISK_BELOW, 300.0, "FRETE_GRATIS", "DESC5"),
    (HIGH_RISK_BELOW, 500.0, "DESC10", "DESC5_FRETE"),
    (None, 800.0, "RECUPE15", "DESC10_FRETE"),
]


def by_value(value: Column, threshold: float, from_threshold: str, below: str) -> Column:
    return F.when(value >= threshold, from_threshold).otherwise(below)


def matrix_code(p: Column, value: Column) -> Column:
    code = F.when(p < LOW_RISK_BELOW, NO_COUPON)
    for bound, threshold, upper, lower in MATRIX:
        choice = by_value(value, threshold, upper, lower)
        code = code.otherwise(choice) if bound is None else code.when(p < bound, choice)
    return code


def profile_code(profile: Column, value: Column) -> Column:
    return (
        F.when(profile == HIGH_INTENT, by_value(value, 300.0, "FRETE_GRATIS", "LEMBRETE_SEM_DESCONTO"))
        .when(profile == BARGAIN_HUNTER, by_value(value, 400.0, "DESC15_VIP", "DESC10_FRETE"))
        .otherwise("DESC5_FRETE")
    )


def urgency_rank(urgency: Column) -> Column:
    rank = F.when(urgency == URGENCY_ORDER[0], 0)
    for i, name in enumerate(URGENCY_ORDER[1:], start=1):
        rank = rank.when(urgency == name, i)
    return rank.otherwise(len(URGENCY_ORDER))


def recovered_gmv(code: Column, value: Column, discount: Column) -> Column:
    expected = value * real(LIFT) * (real(1) - discount)
    return F.when(code != NO_COUPON, expected).otherwise(real(0))


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def recovered_money(code: Column, value: Column, discount: Column) -> Column:
    """``recovered_gmv`` in whole cents. Decimal arithmetic: a product of doubles
    can fall on either side of half a cent."""
    kept = F.lit(Decimal(1)) - discount.cast("decimal(4,2)")
    expected = F.round(money(value) * F.lit(Decimal(str(LIFT))) * kept, 2)
    return money(F.when(code != NO_COUPON, expected).otherwise(F.lit(Decimal(0))))


def stream_recovered_gmv(p: Column, value: Column) -> Column:
    """The streaming path's own estimate, kept apart from ``recovered_gmv``."""
    share = F.when(predicted_abandoned(p) == 1, F.lit(Decimal(str(STREAM_SHARE)))).otherwise(
        F.lit(Decimal("1.00"))
    )
    return F.round(money(value) * share, 2).cast("double")
