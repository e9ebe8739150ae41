from trilode.sinks.write import prepare, save_mode, warehouse_options, write_table, written_rows

__all__ = ["prepare", "save_mode", "warehouse_options", "write_table", "written_rows"]
