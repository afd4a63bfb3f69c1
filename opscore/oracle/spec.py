"""Declared output columns and kinds per key; tests hold both sides to them."""

SPEC = {
    'band_score_capped': [('dia', 'date'), ('matricula', 'int'), ('resolvidos_rec', 'double'), ('score', 'double')],
    'band_score_descending': [('dia', 'date'), ('matricula', 'int'), ('ratio', 'double'), ('score', 'double')],
    'band_score_extrapolated': [('dia', 'date'), ('matricula', 'int'), ('resolvidos_rec', 'double'), ('score', 'double')],
    'band_score_imputed': [('ano_ref', 'int'), ('mes_ref', 'int'), ('matricula', 'int'), ('dto', 'double'), ('p_dto_i', 'double')],
    'between_filter': [('id', 'int'), ('created_at', 'timestamp'), ('destination_id', 'int'), ('checkin', 'date'), ('fk_purchase_searchs_id', 'int')],
    'cast_key_join': [('data_das_respostas', 'date'), ('matricula', 'int'), ('media_', 'double')],
    'collective_month_join': [('dia', 'date'), ('matricula', 'int'), ('valor_ciclo_c', 'double'), ('p_ciclo', 'double')],
    'csat_monthly': [('ano_ref', 'int'), ('mes_ref', 'int'), ('matricula', 'int'), ('media__csat', 'double'), ('p_csat', 'double')],
    'cycle_rate_monthly': [('mes_ref', 'int'), ('ano_ref', 'int'), ('area', 'text'), ('valor_ciclo_c', 'double')],
    'cycle_score_monthly': [('mes_ref', 'int'), ('ano_ref', 'int'), ('valor_ciclo_c', 'double'), ('p_ciclo', 'double'), ('area', 'text'), ('tipo', 'text'), ('origem', 'text')],
    'daily_resolved': [('data_', 'date'), ('matricula', 'int'), ('resolvidos_rec', 'double')],
    'date_floor_filter': [('data_posicao', 'date'), ('area', 'text'), ('fila', 'text'), ('qtde_respondido_dentro_prazo', 'int'), ('qtde_total', 'int'), ('qtde_nao_respondido_fora_prazo_resolvido', 'int')],
    'date_parts': [('id', 'int'), ('ano', 'int'), ('mes', 'int'), ('dia', 'int'), ('data', 'date'), ('checkin', 'date')],
    'distinct_rows': [('order_id', 'int'), ('reason_id', 'int')],
    'dto_individual': [('ano_ref', 'int'), ('mes_ref', 'int'), ('matricula', 'int'), ('dto', 'double'), ('p_dto_i', 'double')],
    'dto_score_monthly': [('mes_ref', 'int'), ('ano_ref', 'int'), ('valor_dto_c', 'double'), ('p_dto', 'double'), ('tipo', 'text'), ('origem', 'text')],
    'employee_day_spine': [('dia', 'date'), ('matricula', 'int')],
    'fiscal_shift': [('dia', 'date'), ('data', 'date')],
    'inner_join_sales': [('id', 'int'), ('iata_from', 'text'), ('iata_to', 'text'), ('order_id', 'int'), ('order_created_at', 'timestamp'), ('last_status', 'int')],
    'knowledge_individual': [('ano_ref', 'int'), ('mes_ref', 'int'), ('matricula', 'int'), ('conhecimento_corporativo', 'double'), ('p_cc_i', 'double')],
    'knowledge_score_monthly': [('mes_ref', 'int'), ('ano_ref', 'int'), ('valor_conhec_c', 'double'), ('p_conhecimento', 'double'), ('tipo', 'text'), ('origem', 'text')],
    'latest_log_join': [('id', 'int'), ('log_id', 'int'), ('cancellation_flight_status_id', 'int'), ('created_original_at', 'timestamp')],
    'latest_sale_per_route': [('iata_from', 'text'), ('iata_to', 'text'), ('fk_search_id', 'int'), ('created_at', 'timestamp'), ('source', 'text')],
    'left_join_active': [('id', 'int'), ('code_bank', 'int'), ('account_type', 'int')],
    'left_join_lookup': [('id', 'int'), ('fk_purchase_searchs_id', 'int'), ('ap', 'text')],
    'loss_month_fanout': [('dia', 'date'), ('matricula', 'int'), ('data_ref', 'date'), ('p_prejuizo', 'int')],
    'loss_penalty_daily': [('data_ref', 'date'), ('matricula', 'int'), ('reembolso_valor_prejuizo', 'double'), ('p_prejuizo', 'int')],
    'metasearch_by_route': [('iata_origem', 'text'), ('iata_destino', 'text'), ('metasearch_count', 'int'), ('source', 'text'), ('created_at', 'timestamp')],
    'month_roster_join': [('data_resolucao', 'date'), ('matricula', 'int'), ('quantidade_incidentes', 'double'), ('area', 'text'), ('matricula_supervisor', 'int')],
    'month_target_join': [('data_', 'date'), ('matricula', 'int'), ('resolvidos_rec', 'double'), ('m_ouro', 'double'), ('p_ouro', 'double')],
    'monthly_grade_avg': [('ano_ref', 'int'), ('mes_ref', 'int'), ('valor_conhec_c', 'double'), ('valor_dto_c', 'double')],
    'normalised_match': [('ref', 'date'), ('indicador', 'text'), ('tipo', 'text'), ('origem', 'text'), ('untrimmed_match', 'bool')],
    'null_tests': [('id', 'int'), ('money_missing', 'bool'), ('has_miles', 'bool')],
    'production_score': [('data_resolucao', 'date'), ('matricula', 'int'), ('producao', 'double'), ('p_produtividade', 'double')],
    'production_with_absence': [('data_resolucao', 'date'), ('matricula', 'int'), ('producao', 'double'), ('area', 'text'), ('escala', 'text')],
    'queue_not_in_filter': [('data_posicao', 'date'), ('area', 'text'), ('fila', 'text'), ('qtde_respondido_dentro_prazo', 'int'), ('qtde_total', 'int'), ('qtde_nao_respondido_fora_prazo_resolvido', 'int')],
    'recontact_daily': [('data_', 'date'), ('matricula', 'int'), ('area_gabi', 'text'), ('recorrencia', 'double')],
    'recontact_events': [('data_', 'date'), ('matricula', 'int'), ('fila', 'text'), ('area', 'text')],
    'recontact_monthly': [('ano_ref', 'int'), ('mes_ref', 'int'), ('matricula', 'int'), ('resolvidos_rec', 'double'), ('recorrencia', 'double'), ('percent_recorrencia', 'double'), ('p_recorrencia', 'double')],
    'refund_item_total': [('id', 'int'), ('valor_estorno', 'double')],
    'refund_kind': [('id', 'int'), ('refund_order_id', 'int'), ('refund_order_miles_id', 'int'), ('tipo', 'text')],
    'refund_ledger': [('ID', 'int'), ('BANCO', 'text'), ('NUMERO', 'int'), ('AGEN', 'text'), ('CONTA', 'text'), ('CORRENTEPOUPANCA', 'text'), ('NOMECOMPLETO', 'text'), ('CPFCNPJ', 'text'), ('VALORESTORNO', 'double'), ('VALOR', 'double'), ('ORConvencional', 'int'), ('ORMilhas', 'int'), ('TIPOEDEESTORNO', 'text'), ('STATUSOR', 'text'), ('AGENTE', 'text'), ('MOTIVO', 'text'), ('DATAULTIMAATUALIZACAO', 'timestamp'), ('DATACRIACAOOR', 'timestamp')],
    'refund_status_union': [('id', 'int'), ('status', 'text')],
    'resolution_rate_daily': [('data_resolucao', 'date'), ('matricula', 'int'), ('percent_resolucao', 'double'), ('resolvidos', 'double')],
    'resolution_score_daily': [('data_resolucao', 'date'), ('matricula', 'int'), ('percent_resolucao', 'double'), ('resolvidos', 'double'), ('p_resolutividade', 'double'), ('matricula_supervisor', 'int'), ('matricula_coordenador', 'int'), ('matricula_gerente', 'int')],
    'rolling_days_filter': [('fk_order_id', 'int'), ('created_at', 'timestamp'), ('source', 'text')],
    'roster_filter': [('mode', 'text'), ('matricula', 'int'), ('mes_referencia', 'date'), ('funcao', 'text'), ('area', 'text')],
    'route_demand': [('iata_origem', 'text'), ('iata_destino', 'text'), ('metasearch_count', 'int'), ('financial_count', 'int'), ('ultimo_fk_search_id', 'int'), ('ultimo_created_at', 'timestamp'), ('metasearch_created_at', 'timestamp'), ('source', 'text')],
    'sales_by_route': [('iata_origem', 'text'), ('iata_destino', 'text'), ('financial_count', 'int'), ('fk_search_id', 'int'), ('created_at', 'timestamp'), ('source', 'text')],
    'sales_count_window': [('iata_from', 'text'), ('iata_to', 'text'), ('id', 'int'), ('created_at', 'timestamp'), ('source', 'text'), ('financial_count', 'int')],
    'scorecard_daily': [('data_resolucao', 'date'), ('matricula', 'int'), ('percent_resolucao', 'double'), ('resolvidos', 'double'), ('p_resolutividade', 'double'), ('recorrencia', 'double'), ('resolvidos_rec', 'double'), ('producao', 'double'), ('p_produtividade', 'double'), ('assiduidade', 'int'), ('valor_ciclo_c', 'double'), ('p_ciclo_c', 'double'), ('valor_conhec_c', 'double'), ('p_conhecimento_c', 'double'), ('pontos_ideia_c', 'double'), ('valor_dto_c', 'double'), ('p_dto_c', 'double'), ('reclamacoes', 'double'), ('p_reclamacoes', 'double'), ('nps', 'double'), ('p_nps', 'double'), ('redes_sociais', 'double'), ('p_redes_sociais', 'double'), ('ultima_atualizacao', 'timestamp')],
    'scorecard_final': [('data_resolucao', 'date'), ('matricula', 'int'), ('percent_resolucao', 'double'), ('resolvidos', 'double'), ('p_resolutividade', 'double'), ('percent_recorrencia', 'double'), ('recorrencia', 'double'), ('resolvidos_rec', 'double'), ('p_recorrencia', 'double'), ('media__csat', 'double'), ('p_csat', 'double'), ('producao', 'double'), ('p_produtividade', 'double'), ('assiduidade', 'int'), ('p_prejuizo', 'int'), ('dto', 'double'), ('p_dto_i', 'double'), ('conhecimento_corporativo', 'double'), ('p_cc_i', 'double'), ('valor_ciclo_c', 'double'), ('p_ciclo_c', 'double'), ('valor_conhec_c', 'double'), ('p_conhecimento_c', 'double'), ('pontos_ideia_c', 'double'), ('valor_dto_c', 'double'), ('p_dto_c', 'double'), ('reclamacoes', 'double'), ('p_reclamacoes', 'double'), ('nps', 'double'), ('p_nps', 'double'), ('redes_sociais', 'double'), ('p_redes_sociais', 'double'), ('origem', 'text'), ('tipo', 'text'), ('matricula_supervisor', 'int'), ('supervisor', 'text'), ('matricula_coordenador', 'int'), ('coordenador', 'text'), ('matricula_gerente', 'int'), ('gerente', 'text'), ('ultima_atualizacao', 'timestamp')],
    'search_dashboard': [('Data', 'date'), ('Pesquisas', 'int'), ('destination_id', 'int'), ('Checkin', 'date'), ('ap', 'text')],
    'search_dashboard_sql': [('Data', 'date'), ('Pesquisas', 'int'), ('destination_id', 'int'), ('Checkin', 'date'), ('ap', 'text')],
    'shift_class': [('matricula', 'int'), ('mes_referencia', 'date'), ('horario_inicio', 'text'), ('horario_fim', 'text'), ('escala', 'text')],
    'shift_class_production': [('data_resolucao', 'date'), ('matricula', 'int'), ('area', 'text'), ('escala', 'text'), ('producao', 'double')],
    'status_in_filter': [('id', 'int'), ('fk_search_id', 'int'), ('created_at', 'timestamp'), ('last_status', 'int')],
    'tracking_rank': [('fk_order_id', 'int'), ('created_at', 'timestamp'), ('source', 'text'), ('rn', 'int')],
    'trailing_id_window': [('id', 'int'), ('created_at', 'timestamp'), ('destination_id', 'int'), ('checkin', 'date'), ('fk_purchase_searchs_id', 'int')],
    'union_distinct': [('data_resolucao', 'date'), ('matricula', 'int'), ('area', 'text'), ('producao', 'double'), ('escala', 'text')],
    'union_null_padded': [('data_resolucao', 'date'), ('matricula', 'int'), ('producao', 'double'), ('p_produtividade', 'double')],
    'worst_production_per_day': [('data_resolucao', 'date'), ('matricula', 'int'), ('producao', 'double'), ('area', 'text'), ('escala', 'text')],
}
