from tabulae.sources.io import (  # noqa: F401
    checkpoint_dir, cut_lineage, delivery_path, exists, listing, load_delivery, chosen_parameters, load_model,
    read_results, read_table, read_text, save_model, typed_table, write_bucketed, write_results,
    write_table,
)
from tabulae.sources.shared import shared_folder, written  # noqa: F401
