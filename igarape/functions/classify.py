"""Classification of a water sample by the text of its result field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from igarape.constants import MICROBIAL_PARAMETERS, PH_RANGE, UPPER_LIMITS
from igarape.functions.numeric import numbers_in_text
from igarape.functions.text import as_column, normalise_signs, to_ascii

# --- fixed values: class names and label patterns ----------------------------
TOTAL = "total"
CONFORM = "conforme"
NON_CONFORM = "nao_conforme"
PERCENTILE = "percentil_95"
UNCLASSIFIED = "nao_classificado"
CLASSES = [TOTAL, CONFORM, NON_CONFORM, PERCENTILE, UNCLASSIFIED]

_CHLORINE_BAD = "> ?5[.,]0|< ?0[.,]2"
_CHLORINE_FROM = ">= ?(0[.,]2|2[.,]0)"
_CHLORINE_TO = "<= ?(5[.,]0|2[.,]0)"


def sample_class(
    parameter: Column | str,
    label: Column | str,
    percentile_first: bool = True,
    inclusive_bounds: bool = False,
) -> Column:
    """Class of a sample; what no rule decides is "nao_classificado".

    percentile_first: test "percentil 95" before the rules per parameter; tested
    last, it is never reached for the parameters that have rules.
    inclusive_bounds: let "> 5,0" count as above a limit of 5,0.
    """
    kind = as_column(parameter)

    def classified(text: Column) -> Column:
        numbers = numbers_in_text(text)
        least, most = F.array_min(numbers), F.array_max(numbers)

        def above(limit: Column | float) -> Column:
            return least >= limit if inclusive_bounds else least > limit

        def below(limit: Column | float) -> Column:
            return most <= limit if inclusive_bounds else most < limit

        presence = F.when(text.contains("ausencia"), CONFORM).when(text.contains("presenca"), NON_CONFORM)

        chlorine = F.when(text.rlike(_CHLORINE_BAD), NON_CONFORM).when(
            text.rlike(_CHLORINE_FROM) & text.rlike(_CHLORINE_TO), CONFORM
        )

        limits = F.create_map(*[F.lit(x) for pair in UPPER_LIMITS.items() for x in pair])
        limit = F.try_element_at(limits, kind)
        upper_bound = F.when(text.contains("<") & (most <= limit), CONFORM).when(
            text.contains(">") & ~text.contains("<=") & above(limit), NON_CONFORM
        )

        low, high = PH_RANGE
        both_signs = text.contains(">=") & text.contains("<=")
        ph = (
            F.when(both_signs & (F.get(numbers, F.lit(0)) >= low) & (F.get(numbers, F.lit(1)) <= high), CONFORM)
            .when(text.rlike("<|lt") & below(low), NON_CONFORM)
            .when(text.rlike(">|gt") & above(high), NON_CONFORM)
        )

        by_parameter = (
            F.when(kind.isin(MICROBIAL_PARAMETERS), F.coalesce(presence, F.lit(UNCLASSIFIED)))
            .when(kind == "cloro_residual_livre", F.coalesce(chlorine, F.lit(UNCLASSIFIED)))
            .when(limit.isNotNull(), F.coalesce(upper_bound, F.lit(UNCLASSIFIED)))
            .when(kind == "ph", F.coalesce(ph, F.lit(UNCLASSIFIED)))
        )
        percentile = F.when(text.contains("percentil 95"), PERCENTILE)
        rest = [percentile, by_parameter] if percentile_first else [by_parameter, percentile]
        return F.coalesce(
            F.when(text.contains("amostras analisadas"), TOTAL), *rest, F.lit(UNCLASSIFIED)
        )

    # The label is folded once, however many rules look at it.
    folded = to_ascii(F.lower(normalise_signs(label)))
    return F.get(F.transform(F.array(folded), classified), F.lit(0))
