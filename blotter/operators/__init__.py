
from blotter.operators.correspondence import CAResult, ca_biplot, ca_inertia, ca_residuals, correspondence
from blotter.operators.crosstab import crosstab_long, crosstab_wide, pair_counts, wide_to_long
from blotter.operators.demographics import assemble_demographics, unpivot_years
from blotter.operators.harmonize import (harmonize, in_domain, in_domain_or_null, map_codes, record_type,
                                         since, to_double)
from blotter.operators.ranking import top_categories, top_categories_by_field, top_values
from blotter.operators.regression import (attach_demographics, correlations, elastic_net, ols_general,
                                          ols_tests, region_year_facts)
from blotter.operators.sampling import hash_unit, stratified_sample, stratified_sample_hash
from blotter.operators.scaling import clip_symmetric, cluster_rows, minmax, row_zscore_clip, zscore
from blotter.operators.spatial import (explode_edges, grid_counts, group_extent, heat_layer, kernel_density,
                                       kernel_radius, region_cells, region_edges, region_year_counts, tag_points,
                                       tagged_counts, valid_points)
from blotter.operators.temporal import (daily_pivot, hourly_pivot, monthly_resample, pivot_to_long,
                                        seasonal_profile)

__all__ = [
    "CAResult", "ca_biplot", "ca_inertia", "ca_residuals", "correspondence",
    "crosstab_long", "crosstab_wide", "pair_counts", "wide_to_long",
    "assemble_demographics", "unpivot_years",
    "harmonize", "in_domain", "in_domain_or_null", "map_codes", "record_type", "since", "to_double",
    "top_categories", "top_categories_by_field", "top_values",
    "attach_demographics", "correlations", "elastic_net", "ols_general", "ols_tests", "region_year_facts",
    "hash_unit", "stratified_sample", "stratified_sample_hash",
    "clip_symmetric", "cluster_rows", "minmax", "row_zscore_clip", "zscore",
    "explode_edges", "grid_counts", "group_extent", "heat_layer", "kernel_density", "kernel_radius",
    "region_cells",
    "region_edges", "region_year_counts", "tag_points", "tagged_counts", "valid_points",
    "daily_pivot", "hourly_pivot", "monthly_resample", "pivot_to_long", "seasonal_profile",
]
