"""Readers and writers: landmark files, image inventories, tables, run ledgers."""
