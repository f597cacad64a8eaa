"""A small raw data set with the defects real files have. Written by hand for these tests."""

CSV = {
    "clients": """client_id,client_name,company_id,country,sector,created_at,updated_at_sys
1, Alfa ,1,spain,Farma,2021-01-01,2023-01-01
1, Alfa ,1,spain,Farma,2021-01-01,2023-01-01
2,Beta,1,ESPAÑA,,2021-01-01,2023-01-01
2,Beta vieja,1,España,Retail,2021-01-01,31/12/2022
3,Gamma,1,,Retail,n/a,2023-01-01
""",
    "projects": """project_id,project_name,project_code,client_id,client_code,created_at,updated_at_sys,project_exportable
1,Uno,prj1,1,cli1 ,2024-01-01,2024-02-01,True
2,Dos,,2,CLI2,2024-01-01,2024-02-01,False
3, Tres ,PRJ3,2,,2024-01-01,2024-02-01,
4,Cuatro,PRJ4,9,CLI9,2024-01-01,2024-02-01,True
""",
    "campaigns": """campaign_id,campaign_code,campaign_name,project_id,project_code,client_code,campaign_start_date,campaign_end_date,is_active,campaign_state_id,campaign_state,total_visits_planned,total_pos_planned,visit_duration_minutes,created_at,updated_at_sys
1,cam1, Campaña 1 ,1,PRJ1,CLI1,2026-01-01,2026-12-31,True,1,Activa,10,5,45,2025-12-01,2026-01-01
2,,Campaña 2,2,,CLI2,15/02/2026,01/03/2026,False,1,,10,5,,2025-12-01,2026-01-01
3,CAM3,Campaña 3,77,prj3,CLI2,2026-07-01,2026-08-01,,1,En preparación,10,5,30,2025-12-01,2026-01-01
4,CAM4,Campaña 4,78,nada,cli1,sin fecha,2026-08-01,True,1,,10,5,30,2025-12-01,2026-01-01
4,CAM4,Campaña 4 vieja,1,PRJ1,CLI1,2026-01-01,2026-08-01,True,1,,10,5,30,2025-12-01,2025-12-31
""",
    "questions": """question_id,campaign_id,campaign_code,question_code,question_name,question_type,question_category,question_order,question_is_highlighted,image_associated,created_at,updated_at_sys
1,1,cam1, q1,¿Hay stock?,s,Stock,1,True,False,2026-01-01,2026-01-01
2,1,CAM1,,"Precio, IVA incl.", n ,Precio,2,False,,2026-01-01,2026-01-01
3,9,CAM9,Q3,Otra,x,,3,,,2026-01-01,2026-01-01
""",
    "workers": """employee_id,employee_first_name,employee_active_status,employee_hire_date,employee_address_province,employee_contract_type,company_id,created_at,updated_at_sys
1,Ana,True,2020-01-01,León,,1,2020-01-01,2025-01-01
11,Luis,False,,Soria,indef,1,2020-01-01,2025-01-01
 11 ,Luis,False,,Soria,indef,1,2020-01-01,2025-01-01
2,Ana,,2020-01-01, soria ,Part,1,2020-01-01,2025-01-01
""",
    "pos": """intervention_point_id,intervention_point_code,intervention_point_name,intervention_point_address,intervention_point_province,intervention_point_locality,intervention_point_postal_code,intervention_point_latitude,intervention_point_longitude,intervention_point_is_active,created_at,updated_at
1,pdv1,Farmacia 1,"Calle 1, 2","Palmas, Las",,08001,41.5,-3.25,True,2020-01-01,2025-01-01
2,pdv2,Farmacia 2,,MADRID,Centro,28001,,,,2020-01-01,2025-01-01
""",
    "routes": """route_id,route_code,route_name,campaign_id,campaign_code,route_start_date,route_end_date,route_status,delegation_code,recall_mail_sent,created_at,updated_at_sys
1,,Ruta 1,1,cam1,2026-01-01,2026-02-01,,dlg1,True,2025-12-01,2026-01-01
2,RUT2,Ruta 2,1,CAM1,2026-01-01,2026-02-01,Alta,,False,2025-12-01,2026-01-01
3,RUT3,Ruta 3,2,CAM2,2026-01-01,2026-02-01,Alta,DLG2,,2025-12-01,2026-01-01
""",
    "route_employee": """route_employee_id,route_id,employee_id,main_employee,ip_percentage,created_at,updated_at,deleted_at
1,1,11,False,,2026-01-01,2026-01-02,
2,1,1,True,100.0,2026-01-01,2026-01-02,05/01/2026
3,1,2,False,10.0,2026-01-01,2026-01-02,
4,2,11,True,100.0,2026-01-01,2026-01-02,
5,3,2,False,50.0,2026-01-01,2026-01-02,
""",
    "visits": """visit_id,campaign_id,campaign_code,project_code,intervention_point_id,intervention_point_code,route_id,route_code,visit_date,visit_time,visit_status,visit_type,is_client_billable,created_at,updated_at_sys
1,1,cam1,prj1,1,pdv1,1,rut1,2026-01-10,9:30:00,ok,normal,True,2026-01-01,2026-01-11
2,1,cam1,prj1,2,pdv2,1,rut1,10/01/2026,25:00:00,INCID,normal,False,2026-01-01,2026-01-11
3,1,cam1,prj1,1,pdv1,,,2026-01-12,,novis,,,2026-01-01,2026-01-11
3,1,cam1,prj1,1,pdv1,,,2026-01-12,,OK,,,2026-01-01,2026-01-10
4,1,cam1,prj1,1,pdv1,70,,2026-01-13,10:00:00, Info ,normal,True,2026-01-01,2026-01-11
5,2,cam2,,1,pdv1,3,rut3,2026-02-20,10:00:00,,normal,True,2026-01-01,2026-01-11
""",
    "responses": '''answer_id,visit_id,question_id,campaign_code,intervention_point_code,question_type,answer,expected_answer,created_at,updated_at_sys
1,1,1,cam1,pdv1, s , Sí ,Sí,2026-01-10,2026-01-10
2,1,2,cam1,pdv1,,"12,50 ""IVA""",,2026-01-10,2026-01-10
3,2,,cam1,pdv2,T,   ,texto,2026-01-10,2026-01-10
4,3,1,cam1,pdv1,S,No,Sí,2026-01-12,2026-01-12
4,3,1,cam1,pdv1,S,Antes,Sí,2026-01-12,2026-01-11
5,5,3,cam2,pdv1,,x,y,2026-02-20,2026-02-20
''',
}

AS_OF = "2026-06-05"


def write_raw(folder, changes=None):
    for name, content in {**CSV, **(changes or {})}.items():
        (folder / f"raw_{name}.csv").write_bytes(content.replace("\n", "\r\n").encode())
    return str(folder)
